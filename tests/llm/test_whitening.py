"""Whitening against a plain eigendecomposition, and the rank-one changes it is made of."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowlab.llm import whitening
from flowlab.llm.queries import QUERIES
from flowlab.llm.secular import Spectrum, rank_one

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, y long, part string"


def plain(vectors, k=16):
    """The contract, by definition: rows of (id, component) -> (n, deviation, whitened, explained)."""
    x = {i: tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for i, v in vectors}
    distinct = sorted(set(x.values()))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    away = np.array([[n * c - s for c, s in zip(v, sums)] for v in distinct], np.float64) / n
    e, u = np.linalg.eigh(away.T @ away / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(k, int((e > 1e-12 * e.sum()).sum()))
    out = {}
    for i, v in x.items():
        far = [n * c - s for c, s in zip(v, sums)]
        white = (np.array(far, float) / n) @ u[:, :k] / np.sqrt(e[:k])
        for j in range(k):
            out[i, j + 1] = (n, sum(f * f for f in far), white[j], e[j] / e.sum())
    return out


def agree(rows, want):
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(got) == len(rows) and set(got) == set(want)
    signs = {}
    for (i, j), (n, far, white, explained) in want.items():
        r = got[i, j]
        assert r.n == n and int(r.deviation) == far and r.explained == pytest.approx(explained, rel=1e-9) and r.identity_error <= 1e-9
        if abs(white) > 1e-3:
            assert signs.setdefault(j, np.sign(white * r.whitened)) == np.sign(white * r.whitened)
        assert abs(r.whitened) == pytest.approx(abs(white), abs=1e-7)


def test_the_query_gives_the_definition(spark):
    rows = QUERIES["op13_embedding_whitening"](spark, SF).collect()
    src = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    agree(rows, plain([(r.vec_id, r.embedding) for r in src]))


def whitened(spark, rows, k=16):
    df = spark.createDataFrame(rows, SCHEMA)
    return whitening.whiten(df, whitening.fit(df, k)).collect()


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(c) for c in rng.integers(-90, 90, 5) / 64]) for i in range(40)]
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [nan] * 5), (103, [0.0, inf, 0.0, 0.0, -inf]), (104, []), (105, [1.0] * 4)]
    hot = [(200 + i, good[0][1]) for i in range(60)]                 # copies count once in the fit, each has its rows
    rows = [(i, v, 7, "z") for i, v in good + bad + hot]
    agree(whitened(spark, rows), plain(good + hot))
    got = whitened(spark, rows + [(None, good[1][1], 1, None), (3, good[3][1], 1, "a")], k=2)
    assert sum(r.vec_id is None for r in got) == 2 and sum(r.vec_id == 3 for r in got) == 4


def test_small_ranks_and_empty_tables(spark):
    assert whitened(spark, []) == [] and whitened(spark, [(1, None, 1, "")]) == [] and whitened(spark, [(1, [], 1, "")]) == []
    assert whitened(spark, [(1, [1.0, 2.0], 1, ""), (2, [1.0, 2.0], 1, "")]) == []      # one distinct vector: no variance
    line = [(i, [float(i), 2.0 * i, -3.0 * i]) for i in range(9)]                        # rank one: one component
    agree(whitened(spark, [(i, v, 0, "") for i, v in line]), plain(line))
    far = [(i, [1e9 * i, float(i % 3)]) for i in range(50)]                              # deviations beyond 64 bits stay exact
    want = plain(far)
    got = {(r.vec_id, r.component): int(r.deviation) for r in whitened(spark, [(i, v, 0, "") for i, v in far])}
    assert max(got.values()) > 2 ** 64 and got == {k: v[1] for k, v in want.items()}


def test_partitions_do_not_change_the_result(spark, monkeypatch):
    src = spark.read.parquet(f"{SF}/embeddings.parquet")
    one = whitening.fit(src, 16)
    monkeypatch.setattr(whitening, "TASK_VECTORS", 9)                # 56 tasks: joined in two levels
    many = whitening.fit(src, 16)
    assert (one.n, one.sums) == (many.n, many.sums)
    np.testing.assert_allclose(one.values, many.values, rtol=1e-11)
    np.testing.assert_allclose(np.abs(one.vectors[:, :16]), np.abs(many.vectors[:, :16]), atol=1e-7)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 40), st.sampled_from(["normal", "whole", "repeated", "line"]), st.integers(0, 10_000))
def test_spectra_equal_the_scatter(dims, n, kind, seed):
    rng = np.random.default_rng(seed)
    x = {"normal": lambda: rng.normal(size=(n, dims)) * 10 ** rng.uniform(-4, 4, dims), "whole": lambda: rng.integers(-2, 3, (n, dims)),
         "repeated": lambda: rng.normal(size=(3, dims))[rng.integers(0, 3, n)], "line": lambda: np.outer(rng.normal(size=n), rng.normal(size=dims))}[kind]().astype(float)
    a, b = Spectrum(dims), Spectrum(dims)
    for i, v in enumerate(x):
        (a if i % 3 else b).add(v)
    a.join(b)
    want = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    size = max(np.abs(want).max(), 1e-300)
    assert np.abs(a.vectors * a.values @ a.vectors.T - want).max() <= 1e-10 * size
    assert np.abs(a.vectors.T @ a.vectors - np.eye(dims)).max() <= 1e-10 and (np.diff(a.values) >= 0).all()


def test_a_change_of_nothing_and_of_equal_values():
    d, u = np.array([1.0, 1.0, 1.0, 2.0]), np.eye(4)
    same, axes = rank_one(d, u, np.zeros(4), 1.0)
    assert same is d and axes is u
    e, q = rank_one(d, u, np.ones(4), 0.5)
    np.testing.assert_allclose(q * e @ q.T, np.diag(d) + 0.5, atol=1e-14)
    assert np.isclose(e, 1.0).sum() == 2                             # two of the three equal values are deflated
