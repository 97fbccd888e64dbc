import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from flowlab.llm import ngram_lm as lm
from flowlab.llm.elias_fano import EliasFano
from flowlab.llm.word_hashes import hashes, lowered, word_places

ODD = ["", " ", "A", "", "x" * 500 + " " + "Yz" * 16 + " " + "q" * 31 + " " + "w" * 32, "\x1c\x85 \x00 a\x00", "É é\xa0Z", ""]


def hashed(texts: pa.Array):
    low, text_ends = lowered(texts)
    begins, ends, last = word_places(low, text_ends)
    return hashes(low, begins, ends).tolist(), last.tolist()


def test_words_are_hashed_as_xxh64_does():
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choices("abcXYZé字 \t\n\x0b\x0c\r  \x1c\x85\xa0", k=rng.randint(0, 70))) for _ in range(2000)] + ["", "end"]
    for first, n in ((0, len(texts)), (0, 2), (3, 0), (7, 300), (len(texts) - 2, 2)):
        words = [t.encode().lower().split() for t in texts[first:first + n]]
        got, last = hashed(pa.array(texts).slice(first, n))
        assert got == [xxhash.xxh64_intdigest(w) for own in words for w in own]
        assert last == np.cumsum([len(own) for own in words]).astype(int).tolist()
    assert hashed(pa.array([], pa.string())) == ([], [])


def test_no_word_spans_two_texts():
    both, apart = hashed(pa.array(["ab", "", "cd"])), hashed(pa.array(["ab cd"]))
    assert both[0] == apart[0] and both[1] == [1, 1, 2] and hashed(pa.array(["abcd"]))[0] != both[0]


def test_tokens_are_not_looked_up_one_by_one(monkeypatch):
    """Short words cost no call of their own: the finding was on CPU time, most of it one Python object a word."""
    calls, digest = [], xxhash.xxh64_intdigest
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda *a: calls.append(a) or digest(*a))
    texts = pa.array([" ".join(f"w{i}" for i in range(5000))] * 2)
    got, ends = lm._tokens(texts)
    assert len(got) == 10002 and ends.tolist() == [5001, 10002] and len(calls) <= 1
    n = sum(b.column("n").to_numpy().sum() for b in lm._count_words([pa.RecordBatch.from_arrays([texts], names=["t"])]))
    assert n == 10002 and len(calls) <= 2


def test_words_that_share_a_place_stay_apart(monkeypatch):
    monkeypatch.setattr(lm, "SLOTS", 8)
    asked = []
    known = lm._Remembered(lambda h: asked.extend(h.tolist()) or ((h // np.uint64(2)).astype(np.int64), h.astype(np.int64)))
    rng = np.random.default_rng(2)
    for _ in range(50):
        h = rng.integers(0, 40, 30, dtype=np.uint64)
        ids, counts = known(h)
        assert (ids == h // np.uint64(2)).all() and (counts == h).all()
    asked.clear()
    one = np.array([17, 17, 17], np.uint64)
    assert known(one)[1].tolist() == [17] * 3 and known(one)[1].tolist() == [17] * 3 and asked in ([], [17])


@pytest.mark.parametrize("gap", [1, 3, 200, 1 << 13, 1 << 19, 1 << 29, 1 << 37, 1 << 44, 1 << 52])
def test_lists_of_every_size_of_low_bits(gap):
    rng = np.random.default_rng(gap % 1000)
    # even gaps, a long run of neighbours in one bucket, and a long empty stretch
    steps = np.concatenate((rng.integers(1, gap + 1, 700), np.ones(400, int), [gap * 500], rng.integers(1, gap + 1, 300)))
    v = np.cumsum(steps).astype(np.uint64)
    e = EliasFano.of(v)
    assert (e.get(np.arange(len(v))) == v).all() and (e.find(v) == np.arange(len(v))).all()
    here, behind = e.get_next(np.arange(len(v) - 1))
    assert (here == v[:-1]).all() and (behind == v[1:]).all()
    others = np.setdiff1d(np.concatenate((v + np.uint64(1), v - np.uint64(1), rng.integers(0, int(v[-1]) * 2, 500).astype(np.uint64))), v)
    assert (e.find(others) == -1).all()


def test_values_are_read_once_for_each_different_ngram(spark, monkeypatch):
    model = lm.fit(spark.createDataFrame([(1, "a b c a b d"), (2, "b c a b")], "doc_id long, text string"), order=3, min_count=1)
    trie = lm.Trie(*model.spec)
    ids, counts = trie.word_ids(lm._hash(lm.words(b"a b c " * 100)))
    read, values = [], trie.values
    monkeypatch.setattr(trie, "values", lambda level, nodes, name: read.append(len(nodes)) or values(level, nodes, name))
    contexts, nodes = lm._ngram_nodes(trie, ids, counts >= 1, np.array([301]), model.end_id, 2)
    lm._conditional(trie, contexts, ids, counts, model.stats, nodes)
    assert len(read) == 2 and max(read) <= 5


def test_counter_merges_what_waits(monkeypatch):
    monkeypatch.setattr(lm, "HELD", 50)
    rng, c, want = np.random.default_rng(1), lm._Counter(), np.zeros(90, int)
    for _ in range(40):
        k = rng.integers(0, 90, rng.integers(0, 40)).astype(np.uint64)
        c.add(k)
        want += np.bincount(k.astype(int), minlength=90)
    keys, counts = c.merged()
    assert keys.tolist() == np.flatnonzero(want).tolist() and counts.tolist() == want[want > 0].tolist()
    c.clear()
    assert [len(x) for x in c.merged()] == [0, 0]


@pytest.mark.parametrize("sizes", [[0, 0, 5, 0, 1, 70_000, 0, 3], [1, 0, 0, 0], [0, 0, 0, 9], [100_000] * 4])
def test_shards_of_nodes(sizes):
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).tolist()
    trie = lm.Trie("", len(sizes), [starts], 1)
    nodes = np.unique(np.random.default_rng(0).integers(0, sum(sizes), 3000))
    want = np.repeat(np.arange(len(sizes)), sizes)[nodes]
    for ask, of in ((nodes, want), (nodes[::-1], want[::-1]), (nodes[:0], want[:0])):
        assert trie.shard_of(0, ask).tolist() == of.tolist()
        got = np.full(len(ask), -1)
        for s, at in trie._spread(0, ask):
            got[at] = s
        assert got.tolist() == of.tolist()
