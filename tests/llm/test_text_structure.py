import base64
import random
from hashlib import md5, sha256

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from flowlab.llm import chat, merkle
from flowlab.llm.sentence_pieces import MARK, PieceModel, decode, encode
from flowlab.llm.token_counts import length_histogram, length_report, quantiles, token_lengths, truncated_totals


def test_edit_report_against_python(spark):
    texts = {9: "One two three four five six. Seven eight!\nNext line here\n\nNew section é日本.", 7: "", 5: None, 3: "x", 2: "same text here", 1: "same text here",
             4: "word " * 20_000, None: "no id"}
    docs = spark.createDataFrame([(i, t, "f") for i, t in texts.items()], "doc_id long, text string, fingerprint string")
    got = {r.doc_id: r for r in merkle.edit_report(docs).collect()}
    order = sorted((i for i in texts if i is not None), reverse=True) + [None]
    assert len(got) == len(texts)
    for k, i in enumerate(order):
        t, n = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        e = t[:len(t) - len(t) // 2] + n[:len(t) // 2]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == sha256(e.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[1].fingerprint == got[2].fingerprint != got[9].fingerprint and got[2].near_next == 1.0
    assert got[9].fingerprint.split(":")[1].count("/") == 1 and got[9].near_edited > got[9].near_next
    assert merkle.edit_report(docs.limit(0)).count() == 0
    one = merkle.edit_report(docs.where("doc_id = 9")).first()
    assert one.near_next == 1.0
    twice = merkle.edit_report(docs.union(docs)).count()
    assert twice == 2 * len(texts)


def test_tree_leaves_and_roots(spark):
    rows = [(1, "a b c d e f. G h\ni j\n\nk"), (2, "a b c d e f. G h\ni j\n\nK"), (3, "a\u0001\u0001b"), (4, "a\u0001b"), (5, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    t = {r.doc_id: r.n for r in df.select("doc_id", merkle.tree(F.col("text")).alias("n")).collect()}
    h = lambda s: md5(s.encode()).hexdigest()
    assert t[1][0][0] == [h("a b c d e "), h("f. "), h("G h\n")] and t[1][0][1][0] == h("i j\n\n") and t[1][1] == [[h("k")]]
    fps = {r.doc_id: r.fingerprint for r in merkle.fingerprints(df).collect()}
    assert len(set(fps.values())) == 5
    pair = spark.createDataFrame([(fps[1], fps[2]), (fps[1], fps[1])], "a string, b string")
    d = [r[0] for r in pair.select(merkle.differing_branches(F.col("a"), F.col("b"))).collect()]
    assert [(x.section, x.paragraph) for x in d[0]] == [(1, 0)] and d[1] == []


def brute_chats(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t, r or "", x or ""))
    logs = {c: [(r, x) for _, r, x in sorted(v, key=lambda y: (y[0] is not None, y[0] or 0))] for c, v in convs.items()}
    best = {}
    for c, l in logs.items():
        if not any(len(o) > len(l) and o[:len(l)] == l for o in logs.values()):
            best.setdefault(tuple(l), []).append(c)
    return sorted(((min((c for c in cs if c is not None), default=None), len(l), len(cs),
                    "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in l)) for l, cs in best.items()), key=str)


def test_chats_collapse_snapshots(spark):
    rng = random.Random(2)
    rows = []
    for c in range(60):
        n, topic = rng.randint(1, 6), rng.randint(0, 6)
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"t{topic} {t if t < 3 else rng.randint(0, 2)}") for t in range(n)]
    rows += [(100, 0, None, None), (101, 0, "", ""), (101, 1, "user", "x" * 100_000), (None, 0, "user", "alone"), (102, None, "system", "s"), (102, 5, "user", "u")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "r") for r in rows], "conv_id long, turn long, role string, text string, turns int, rendered string")
    got = sorted((tuple(r) for r in chat.render_chats(df).collect()), key=str)
    assert got == brute_chats(rows)
    assert chat.render_chats(df.limit(0)).count() == 0


def test_token_counts(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["alpha", "b", "Gamma,", "日本"], k=rng.choice([1, 3, 50, 2000])))) for i in range(120)]
    rows += [(500, None), (501, ""), (7, "again"), (None, "x y"), (502, "<|endoftext|>")]
    docs = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, n_tokens int")
    want = [len(enc.encode_ordinary(t or "")) for _, t in rows]
    hist = length_histogram(token_lengths(docs, path, public_tokenizers.PATTERN))
    rep = {r.n_tokens: r for r in length_report(hist).collect()}
    assert set(rep) == set(want)
    for n, r in rep.items():
        assert (r.docs, r.docs_up_to, r.tokens_up_to) == (want.count(n), sum(w <= n for w in want), sum(w for w in want if w <= n))
        assert (r.docs_over, r.tokens_over, r.truncated_total) == (sum(w > n for w in want), sum(w for w in want if w > n), sum(min(w, n) for w in want))
    assert [tuple(r) for r in truncated_totals(hist, [1, 60, 10**6]).collect()] == [(m, sum(w > m for w in want), sum(min(w, m) for w in want)) for m in (1, 60, 10**6)]
    s = sorted(want)
    assert [r.n_tokens for r in quantiles(length_report(hist), [0.5, 1.0]).collect()] == [s[-(-len(s) // 2) - 1], s[-1]]
    assert length_report(length_histogram(token_lengths(docs.limit(0), path, public_tokenizers.PATTERN))).count() == 0


def test_pieces_equal_the_library(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(4)
    odd = ["", " ", "  a", "a  b ", "Hello  world\n\n  x\ty", f"{MARK}a b", "日本語 text", "\U0001f600 é", "aaaaaaa aaaa", "́x", "don't!!! 1234", "a" * 5000]
    rows = list(enumerate(odd + ["".join(rng.choices("abehint .,\nÀé", k=rng.randint(1, 80))) for _ in range(200)]))
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows] + [(900, None, "z"), (None, "a b", "z"), (3, rows[3][1], "z")], "doc_id long, text string, ids string")
    enc = encode(docs, path).cache()
    back = {r.doc_id: r.text for r in decode(enc, path).collect()}
    for r in enc.collect():
        t = dict(rows).get(r.doc_id, "a b" if r.doc_id is None else None)
        assert r.ids == sp.encode(t or ""), t
        assert back[r.doc_id] == (t or "").replace(MARK, " ")
    assert encode(docs.limit(0), path).count() == 0
    assert decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), path).first().text is None


@pytest.mark.parametrize("seed", range(5))
def test_unigram_viterbi_is_the_best_split(seed):
    rng = random.Random(seed)
    pieces = {MARK: 0, "a": 1, "b": 2, MARK + "a": 3, "ab": 4, "ba": 5, "aba": 6, MARK + "ab": 7, "bb": 8}
    scores = {p: -rng.uniform(1, 9) for p in pieces}
    m = PieceModel.of(pieces, scores, {}, 9, "unigram")

    def best(w):
        if not w:
            return 0.0, []
        return max(((scores[w[:k]] + best(w[k:])[0], [pieces[w[:k]]] + best(w[k:])[1]) for k in range(1, len(w) + 1) if w[:k] in pieces), key=lambda x: x[0])
    words = sorted({MARK + "".join(rng.choices("ab", k=rng.randint(0, 9))) for _ in range(40)})
    got = m.encode_sorted([w.replace(MARK, " ").encode() for w in words])
    value = {i: scores[p] for p, i in pieces.items()}
    for w, ids in zip(words, got):                 # splits of equal score may differ
        assert abs(sum(value[i] for i in ids) - best(w)[0]) < 1e-9 and "".join(p for i in ids for p in pieces if pieces[p] == i) == w
