import random
from collections import Counter
from math import log10

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowlab.llm import elias_fano
from flowlab.llm import ngram_lm as lm
from flowlab.llm.elias_fano import EliasFano
from flowlab.llm.ngram_lm import END, Trie, _conditional, _hash, fit, score


@settings(max_examples=80, deadline=None)
@given(st.sets(st.one_of(st.integers(0, 300), st.integers(0, (1 << 64) - 1)), max_size=300), st.lists(st.integers(0, (1 << 64) - 1), max_size=20))
def test_elias_fano_get_and_find(values, others):
    v = sorted(values)
    ef = EliasFano.of(np.array(v, np.uint64))
    assert ef.get(np.arange(len(v))).tolist() == v
    ask = v + others + [x + 1 for x in v if x + 1 < 1 << 64]
    assert ef.find(np.array(ask, np.uint64)).tolist() == [v.index(x) if x in values else -1 for x in ask]


def test_elias_fano_pointers_with_repeats():
    v = np.sort(np.random.default_rng(1).integers(0, 50, 400))
    assert EliasFano.of(v).get(np.arange(400)).tolist() == v.tolist()


def tokens(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w] + ["</s>"]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_against_plain_counts(spark, order):
    rng = random.Random(order)
    vocab = [f"w{i}" for i in range(12)] + ["The", "x y", "é"]
    rows = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 40)))) for i in range(400)] + [(900, None), (901, "unseen wörds w1 w2"), (901, "w1"), (None, "w2 w3")]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")
    train = [t for i, t in rows if i is None or i < 300]
    got = score(docs, fit(docs.where("doc_id is null or doc_id < 300"), order=order)).collect()
    uni = Counter(w for t in train for w in tokens(t))
    total, vocab_n = sum(uni.values()), len(uni)
    one, two = (sum(n == k for n in uni.values()) for k in (1, 2))
    d1 = one / (one + 2 * two) if one and two else 0.5
    assert len(got) == len(rows)
    want = []
    for i, t in rows:
        w = tokens(t)
        want.append((i, len(w), sum(x in uni for x in w), total, sum(log10((uni.get(x, 0) + 1) / (total + vocab_n + 1)) for x in w)))
    key = lambda r: (str(r[0]), r[1], round(r[4], 6))
    for a, b in zip(sorted((tuple(r)[:5] for r in got), key=key), sorted(want, key=key)):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-6

    def p1(x):
        return (uni[x] - d1) / total if x in uni else d1 * vocab_n / total

    if order == 1:
        by = {r.doc_id: r.score for r in got if r.doc_id and r.doc_id < 901}
        for i, t in rows[:401]:
            if i in by:
                assert abs(by[i] - sum(log10(p1(x)) for x in tokens(t))) < 1e-6


def plain_scorer(train, order):
    """Interpolated absolute discounting over all n-grams, one discount for each order; before a
    text's first word stands the end of another."""
    grams = [Counter() for _ in range(order)]
    for t in train:
        w = ["</s>", *tokens(t)]
        for k in range(order):
            grams[k].update(tuple(w[i - k:i + 1]) for i in range(1, len(w)) if i - k >= 0)
    total, vocab = sum(grams[0].values()), len(grams[0])
    discount = []
    for g in grams:
        one, two = (sum(n == k for n in g.values()) for k in (1, 2))
        discount.append(one / (one + 2 * two) if one and two else 0.5)
    freed = [Counter() for _ in range(order)]
    for k in range(1, order):
        for g, n in grams[k].items():
            freed[k][g[:-1]] += (n - discount[k]) / grams[k - 1][g[:-1]]

    def p(g):
        if len(g) == 1:
            return (grams[0][g] - discount[0]) / total if g in grams[0] else discount[0] * vocab / total
        k, context = len(g) - 1, g[:-1]
        if context not in grams[k - 1]:
            return p(g[1:])
        own = (grams[k][g] - discount[k]) / grams[k - 1][context] if g in grams[k] else 0.0
        return own + (1 - freed[k][context]) * p(g[1:])

    def score_text(t):
        w = ["</s>", *tokens(t)]
        return sum(log10(p(tuple(w[max(0, i - order + 1):i + 1]))) for i in range(1, len(w)))

    return score_text


@pytest.mark.parametrize("order,tokens_per_shard", [(2, 1 << 20), (3, 1 << 20), (3, 40)])
def test_scores_against_plain_ngrams(spark, monkeypatch, order, tokens_per_shard):
    """Few n-grams for each shard, so nearly every value has a bin of its own."""
    from flowlab.llm import ngram_lm

    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", tokens_per_shard)
    rng = random.Random(order)
    vocab = [f"w{i}" for i in range(40)] + ["The", "é"]
    rows = [(i, " ".join(rng.choices(vocab, weights=range(1, 43), k=rng.randint(0, 18)))) for i in range(90)]
    held = [(900 + i, " ".join(rng.choices([*vocab, "new"], k=rng.randint(0, 30)))) for i in range(60)] + [(990, None), (991, ""), (992, "w41 " * 2000)]
    docs = spark.createDataFrame(rows + held, "doc_id long, text string")
    got = {r.doc_id: r for r in score(docs, fit(docs.where("doc_id < 900"), order=order, min_count=1)).collect()}
    plain = plain_scorer([t for _, t in rows], order)
    for i, t in rows + held:
        assert abs(got[i].score - plain(t)) < 2e-3 * got[i].n_tokens, (i, t)
    assert abs(sum(r.score for r in got.values()) / sum(plain(t) for _, t in rows + held) - 1) < 1e-3


@pytest.mark.parametrize("order", [2, 3])
def test_every_context_gives_a_distribution(spark, order):
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(9)]
    texts = [" ".join(rng.choices(vocab, weights=range(1, 10), k=rng.randint(1, 30))) for _ in range(300)] + ["seldom"]
    m = fit(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), order=order)
    trie = Trie(*m.spec)
    names = [*(w.encode() for w in vocab), END, b"seldom"]
    ids, counts = trie.word_ids(_hash([*names, b"never seen"]))
    pairs = Counter(g for t in texts for g in zip(tokens(t), tokens(t)[1:]))
    for u in vocab:
        word = trie.word_ids(_hash([u.encode()]))[0]
        contexts = [np.repeat(word, len(ids))]
        if order == 3:                                       # w8 and then u
            contexts.append(np.repeat(trie.children(1, trie.word_ids(_hash([b"w8"]))[0], word), len(ids)))
        p = 10 ** _conditional(trie, contexts, ids, counts, m.stats)
        assert abs(p.sum() - 1) < 0.02                       # up to the quantised values; the last is all unseen words
        if order == 2:
            n = sum(c for g, c in pairs.items() if g[0] == u)
            for w, x in zip(vocab, p):
                assert abs(x - pairs[u, w] / n) < 0.05


def test_empty_corpus_and_empty_input(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in score(docs, fit(docs.limit(0))).collect()}
    assert got[1].n_tokens == 3 and got[1].n_known == 0 and got[1].train_tokens == 0 and got[1].base_score == 0 == got[2].score
    assert score(docs.limit(0), fit(docs)).count() == 0


def test_places_in_words_and_lists():
    rng = np.random.default_rng(3)
    words = np.append(rng.integers(1, 1 << 63, 300, dtype=np.uint64) >> rng.integers(0, 60, 300).astype(np.uint64) | np.uint64(1), np.uint64((1 << 64) - 1))
    for w in words.tolist():
        at = [i for i in range(64) if w >> i & 1]
        assert elias_fano._select_in_word(np.full(len(at), w, np.uint64), np.arange(len(at))).tolist() == at
    values = np.unique(rng.integers(0, 1 << 30, 5000, dtype=np.uint64))
    e = elias_fano.EliasFano.of(values)
    assert (e.zeros + e.ones == 64 * np.arange(len(e.ones))).all()          # kept, not counted anew for each search
    assert (e.get(np.arange(len(values))) == values).all() and (e.find(values) == np.arange(len(values))).all()


def test_a_score_asks_for_each_node_once(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c a b d"), (2, "b c a b"), (3, ""), (4, "x a b")], "doc_id long, text string")
    model = lm.fit(docs, order=3, min_count=1)
    trie = lm.Trie(*model.spec)
    text = lm.words(b"a b c q b d") + lm.words(b"a b")
    ids, counts = trie.word_ids(lm._hash(text))
    asked, children = [], trie.children
    monkeypatch.setattr(trie, "children", lambda level, nodes, words: asked.append(level) or children(level, nodes, words))
    contexts, nodes = lm._ngram_nodes(trie, ids, counts >= 1, np.array([7, 10]), model.end_id, 2)
    found = lm._conditional(trie, contexts, ids, counts, model.stats, nodes)
    assert asked == [1, 2]
    assert np.array_equal(found, lm._conditional(trie, contexts, ids, counts, model.stats)) and contexts[1][7] == -1 and contexts[1][2] >= 0
