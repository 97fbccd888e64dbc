"""Removal of repeated windows against the definition, and the suffix sort it is made of."""

import hashlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowlab.llm import repeated_spans, suffix_sort
from flowlab.llm.queries import QUERIES
from flowlab.llm.suffix_sort import PrefixHashes, sort_buckets

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def plain(rows, length=100):
    """The contract by definition: rows (doc_id, text) -> sorted (doc_id, n_bytes, spans, kept)."""
    def order(r):
        data = (r[1] or "").encode()
        return (r[0] is not None, r[0] or 0, hashlib.sha256(data).digest())

    seen, out = set(), []
    for doc_id, text in sorted(rows, key=order):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            w = data[s:s + length]
            if w in seen:
                gone[s:s + length] = b"\x01" * length
            seen.add(w)
        spans, s = [], None
        for i, g in enumerate([*gone, 0]):
            if g and s is None:
                s = i
            if not g and s is not None:
                spans.append((s, i))
                s = None
        out.append((doc_id, len(data), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return out


def result(df):
    return sorted(repr((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.removed], bytes(r.kept))) for r in df.collect())


@pytest.mark.parametrize("sf", [SF, SF2])
def test_the_query_gives_the_definition(spark, sf):
    src = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    want = {i: (n, sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest()) for i, n, spans, kept in plain(src)}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op12_repeated_spans"](spark, sf).collect()}
    assert got == want and len(got) == len(src) and any(g[1] for g in got.values())


def small_groups(monkeypatch):
    for name, value in {"SLICE_BYTES": 700, "PIECE": 257, "GROUP_HASHES": 50, "GROUP_BYTES": 900, "TASK_SLICES": 2}.items():
        monkeypatch.setattr(repeated_spans, name, value)


PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards brew a bitter potion of roots. " * 2
ROWS = [(5, PASSAGE), (9, "before " + PASSAGE[:150] + " after"), (2, PASSAGE[20:140]), (7, "x" * 450), (8, "x" * 130), (None, PASSAGE[:120]), (11, None), (12, ""), (13, "short"),
        (14, "short"), (20, "abcde" * 60), (21, "é" * 120), (22, "zé" + "é" * 100), (30, PASSAGE), (30, PASSAGE), (31, "other text " + PASSAGE), (31, "another text " + PASSAGE),
        (31, "another text " + PASSAGE), (40, PASSAGE[:100]), (41, PASSAGE[1:100]), (42, "日本語" * 40), (None, None), (None, "short")] \
    + [(100 + i, f"copy {i} of a hot group: {PASSAGE[:130 + i % 9]} ends with {i % 5}") for i in range(60)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "d", 4, "s") for i, t in rows], "doc_id long, text string, digest string, n_bytes int, slice string")


def test_odd_rows_hot_groups_and_clashing_columns(spark, monkeypatch):
    small_groups(monkeypatch)
    got = repeated_spans.remove_repeats(frame(spark, ROWS), with_kept=True)
    assert result(got) == sorted(map(repr, plain(ROWS)))


def test_other_lengths(spark, monkeypatch):
    small_groups(monkeypatch)
    for length in (2, 17):
        assert result(repeated_spans.remove_repeats(frame(spark, ROWS[:20]), length, with_kept=True)) == sorted(map(repr, plain(ROWS[:20], length)))


def test_empty_table_and_tables_without_windows(spark):
    assert repeated_spans.remove_repeats(frame(spark, [])).collect() == []
    rows = [(1, "a"), (2, None), (3, "a")]
    assert result(repeated_spans.remove_repeats(frame(spark, rows), with_kept=True)) == sorted(map(repr, plain(rows)))


def test_very_long_texts(spark):
    rng = np.random.default_rng(1)
    words = rng.integers(97, 123, (3000, 5)).astype(np.uint8)
    long = b" ".join(bytes(w) for w in words[rng.integers(0, 3000, 500_000)]).decode()
    rows = [(1, long), (2, "start " + long[1_000_000:1_400_000]), (3, "zork " * 100_000), (4, long[:99] + "|")]
    got = {r.doc_id: [(s.start, s.end) for s in r.removed] for r in repeated_spans.remove_repeats(frame(spark, rows)).collect()}
    # the long text's own repeats aside, the passage goes whole; of the repeated word all but its first window's beginning
    assert got[2] == [(6, 400_006)] and got[3] == [(5, 500_000)] and got[4] == [] and got[1] == []


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab", max_size=120), st.integers(1, 9), st.integers(1, 4), st.booleans())
def test_buckets_are_sorted(text, length, buckets, weak):
    data = np.frombuffer(text.encode(), np.uint8)
    start = np.arange(max(len(data) - length + 1, 0))
    bucket = np.sort(start % buckets)
    start = start[np.argsort(start % buckets, kind="stable")]
    hashes = PrefixHashes(data, 1 if weak else suffix_sort.BASE)     # a base of one tells no order: collisions
    order, repeats = sort_buckets(hashes, start, bucket, length)
    want, same = [], []
    for b in sorted(set(bucket.tolist())):
        of = [k for k in range(len(start)) if bucket[k] == b]
        of.sort(key=lambda k: (text[start[k]:start[k] + length], k))
        want += of
        same += [j > 0 and text[start[k]:start[k] + length] == text[start[of[j - 1]]:start[of[j - 1]] + length] for j, k in enumerate(of)]
    assert order.tolist() == want and repeats.tolist() == same


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="abc", max_size=60), max_size=8), st.integers(2, 12))
def test_runs_hold_every_window_once(texts, length):
    data, ends = "".join(texts).encode(), np.cumsum([len(t) for t in texts]).astype(np.int64)
    r = repeated_spans.runs(np.frombuffer(data, np.uint8), ends, length)
    got = [s + k for s, n in zip(r["start"].tolist(), r["n"].tolist()) for k in range(n)]
    assert got == [e - len(t) + k for t, e in zip(texts, ends.tolist()) for k in range(len(t) - length + 1)]
    by = {}
    for s, n, lead, a in zip(*(r[k].tolist() for k in ("start", "n", "lead", "anchor"))):
        for k in range(n):
            by.setdefault(data[s + k:s + k + length], set()).add((a, lead - k))
    assert all(len(v) == 1 for v in by.values())                     # equal windows: the same anchor at the same place


def test_anchors_are_dealt_evenly():
    """Anchors are small hashes; the groups they are dealt to must not follow that."""
    rng = np.random.default_rng(5)
    text = rng.integers(97, 123, 400_000).astype(np.uint8)
    anchors = np.unique(repeated_spans.runs(text, np.array([len(text)]), 100)["anchor"])
    sizes = np.bincount(repeated_spans.group_of(anchors, 16), minlength=16)
    assert sizes.min() > 0.8 * sizes.mean() and sizes.max() < 1.2 * sizes.mean()
