"""REC9 by bounded search and REC5 over the whole catalogue, against brute force."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from flowlab.operators import recsys as rs
from flowlab.operators import similar as sm

SCHEMA = "USER_ID long, ITEM_ID long, TIMESTAMP long"


def brute(events, k):
    c = Counter((u, i) for u, i, _ in events if u is not None and i is not None)
    vec = defaultdict(dict)
    for (u, i), n in c.items():
        vec[i][u] = n
    norm = {i: sum(n * n for n in v.values()) for i, v in vec.items()}
    out = {}
    for x in vec:
        s = []
        for y in vec:
            dot = sum(n * vec[y].get(u, 0) for u, n in vec[x].items()) if x != y else 0
            if dot:
                s.append((-dot / math.sqrt(norm[x] * norm[y]), y))
        for r, (score, y) in enumerate(sorted(s)[:k], 1):
            out[x, r] = (y, -score)
    return out


def events(seed, users=40, items=60, n=700, hot=0):
    rng = random.Random(seed)
    rows = [(rng.randrange(users), min(int(rng.expovariate(0.06)), items - 1), t) for t in range(n)]
    rows += [(999, t % items, t) for t in range(hot)]
    return rows + [(None, 3, 1), (4, None, 1)]


@pytest.mark.parametrize("light,hot", [(1000, 0), (10, 0), (3, 0), (10, 400), (0, 400), (25, 65)])
def test_similar_items_equal_the_full_join(spark, light, hot):
    rows = events(light + hot, hot=hot)
    got = {(r.ITEM_ID, r.rank): (r.SIMILAR_ITEM, r.score) for r in sm.similar_items(spark.createDataFrame(rows, SCHEMA), k=5, light=light).collect()}
    want = brute(rows, 5)
    assert set(got) == set(want)
    assert all(got[k][0] == want[k][0] and math.isclose(got[k][1], want[k][1], rel_tol=1e-12) for k in want)


def test_a_hot_user_adds_few_pairs(spark):
    """Groups of like items, and one user with a third of all events who has them all."""
    rng = random.Random(2)
    items, rows = 1200, []
    for i in range(items):
        rows += [(i // 12 * 20 + rng.randrange(20), i, t) for t in range(6)]
    rows += [(10 ** 6, i, t) for i in range(items) for t in range(3 if i % 50 == 0 else 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    vectors = sm.item_vectors(df, "USER_ID", "ITEM_ID")
    light = sm.both_ways(sm.light_pairs(vectors, 200))
    n_light, n_heavy, full = light.count(), sm.heavy_pairs(vectors, light, 5, 200).count(), items * (items - 1)
    print(f"pairs: light {n_light}, heavy {n_heavy}, full join {full}")
    assert n_heavy <= full / 10
    got = {(r.ITEM_ID, r.rank): r.SIMILAR_ITEM for r in sm.similar_items(df, k=5, light=200).collect()}
    assert got == {k: v[0] for k, v in brute(rows, 5).items()}


@pytest.mark.parametrize("light", [1000, 12])
def test_pairs_are_not_shuffled(spark, light, monkeypatch):
    """No table of pairs is made; blocks and slices of a few pairs give the same lists."""
    rows = events(3, users=60, items=300, n=3000)
    made = []
    monkeypatch.setattr(sm, "light_pairs", lambda *a: made.append(a))
    monkeypatch.setattr(sm, "heavy_pairs", lambda *a: made.append(a))
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, 5)
    for sizes in ((1 << 21, 1 << 24), (300, 2000)):
        monkeypatch.setattr(sm, "STEP", sizes[0])
        monkeypatch.setattr(sm, "BLOCK_PAIRS", sizes[1])
        got = {(r.ITEM_ID, r.rank): r.SIMILAR_ITEM for r in sm.similar_items(df, k=5, light=light).collect()}
        assert got == {k: v[0] for k, v in want.items()} and not made


def test_users_may_be_text(spark):
    rows = events(6, n=300)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("cast(USER_ID as string) USER_ID", "cast(ITEM_ID + 100 as string) ITEM_ID", "TIMESTAMP")
    got = {(r.ITEM_ID, r.rank): r.SIMILAR_ITEM for r in sm.similar_items(df, k=5, light=5).collect()}
    assert got == {(str(i + 100), r): str(y + 100) for (i, r), (y, _) in brute(rows, 5).items()}


def test_similar_items_of_odd_tables(spark):
    def run(rows):
        return [tuple(r) for r in sm.similar_items(spark.createDataFrame(rows, SCHEMA), k=3, light=1).collect()]

    assert run([]) == [] and run([(1, 1, 1)]) == [] and run([(None, 1, 1), (1, None, 1)]) == []
    assert sorted(run([(1, 1, 1), (1, 2, 1), (1, 2, 1)])) == [(1, 1, 2, 1.0), (2, 1, 1, 1.0)]


@pytest.mark.parametrize("blocks", [(1, 1), (3, 4), (100, 100)])
def test_probabilities_over_the_catalogue(spark, blocks):
    rng = np.random.default_rng(7)
    u, v = rng.normal(size=(17, 4)).astype(np.float32) * 6, rng.normal(size=(29, 4)).astype(np.float32) * 6
    v[11] = v[5]                                                      # a tie
    def frame(a):
        return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(a)], "id int, features array<float>")

    got = rs.block_softmax(frame(u), frame(v), 29, *blocks).collect()
    s = u.astype(float) @ v.astype(float).T
    p = np.exp(s - s.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.u, r["rank"])):
        by[r.u].append((r.i, r.score))
    for k in range(17):
        order = np.lexsort((np.arange(29), -s[k]))
        assert [i for i, _ in by[k]] == order.tolist()
        assert np.allclose([x for _, x in by[k]], p[k][order], atol=1e-9) and math.isclose(sum(x for _, x in by[k]), 1.0, rel_tol=1e-9)
    few = rs.block_softmax(frame(u).where("id < 3"), frame(v), 2, *blocks).collect()
    assert sorted((r.u, r["rank"], r.i) for r in few) == sorted((r.u, r["rank"], r.i) for r in got if r.u < 3 and r["rank"] <= 2)
    assert rs.block_softmax(frame(u).limit(0), frame(v), 2, *blocks).collect() == []


def test_probabilities_of_a_model(spark):
    inter = spark.createDataFrame(events(5), SCHEMA).where("USER_ID is not null and ITEM_ID is not null")
    model, uid, iid = rs.train_recommender(inter, rank=4, max_iter=2)
    asked = spark.createDataFrame([(1,), (2,), (77_777,)], "USER_ID long")
    every = rs.recommend_probabilities(model, uid, iid, asked, 1000).collect()
    assert {r.USER_ID for r in every} == {1, 2}
    for u in (1, 2):
        assert math.isclose(sum(r.score for r in every if r.USER_ID == u), 1.0, rel_tol=1e-9)
    first = {(r.USER_ID, r["rank"]): r.ITEM_ID for r in rs.recommend_batch(model, uid, iid, asked, 3).collect()}
    assert {(r.USER_ID, r["rank"]): r.ITEM_ID for r in every if r["rank"] <= 3} == first


def test_scores_are_normalised_for_each_user(spark):
    df = spark.createDataFrame([(u, i, float(u * i)) for u in range(4) for i in range(3)] + [(None, 1, 2.0)], "USER_ID long, ITEM_ID long, score double")
    sums = {r[0]: r[1] for r in rs.normalise_scores(df).groupBy("USER_ID").sum("score").collect()}
    assert len(sums) == 5 and all(math.isclose(s, 1.0) for s in sums.values())
    one = rs.normalise_scores(df.drop("USER_ID")).agg({"score": "sum"}).first()[0]
    assert math.isclose(one, 1.0)
