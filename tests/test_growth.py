"""Plans and operators that have to hold on tables much larger than the tests'."""

from types import SimpleNamespace

import numpy as np
from pyspark.sql import functions as F

from flowlab.operators import joins as jn
from flowlab.operators import recsys as rs
from flowlab.operators import text as tx


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_salted_lookups_are_never_broadcast(spark, tmp_path):
    spark.range(40).select(F.col("id").alias("movieId"), F.concat(F.lit("t"), "id").alias("title"), F.lit("g|h").alias("genres")).write.parquet(f"{tmp_path}/items")
    items = spark.read.parquet(f"{tmp_path}/items")
    events = spark.range(100).select((F.col("id") % 50).alias("item"), F.col("id").alias("u"))
    lists = events.groupBy("u").agg(F.collect_list("item").alias("l"))
    joined = [jn.join_items_interactions(items, events, "movieId", "item"), jn.lookup_title(events, items, "item"),
              jn.enrich_ranked_list(lists, "u", "l", items, "movieId", F.col("title"))]
    assert [("BroadcastHashJoin" in plan(j), j.count()) for j in joined] == [(False, 80), (False, 100), (False, 100)]
    assert joined[1].where("title is null").count() == 20 and joined[2].where("enriched[0] is null").count() == 20


def test_runs_and_tokens_are_neither_shuffled_nor_sorted(spark):
    docs = spark.createDataFrame([(1, "Ab cd, the  ef gh 7 AB CD"), (2, None), (3, ""), (4, "Ünï ab cd the"), (5, " x"), (None, "ab")], "doc_id int, text string")
    got = {(r.doc_id, r.TokenId): (r.Text, r.BeginOffset, r.EndOffset) for r in tx.tokens_with_offsets(docs).collect()}
    assert got[1, 1] == ("Ab", 0, 2) and got[1, 7] == ("CD", 23, 25) and got[4, 2] == ("ab", 4, 6) and got[5, 1] == ("x", 1, 2) and got[None, 1] == ("ab", 0, 2) and len(got) == 13
    text = plan(tx.tokens_with_offsets(docs))
    assert "Window" not in text and text.count("Exchange") == 1                   # the raw text, once
    ph = {(r.doc_id, r["rank"]): (r.Text, r.BeginOffset, r.EndOffset) for r in tx.key_phrases(docs, 2).collect()}
    assert ph[1, 1] == ("Ab cd", 0, 5) and ph[1, 2] == ("ef gh", 12, 17) and ph[4, 1] == ("Ünï ab cd", 0, 9) and ph[5, 1] == ("x", 1, 2)


def test_documents_that_share_an_id_are_one(spark):
    docs = spark.createDataFrame([(1, "ab cd"), (1, "ab cd"), (2, "ef"), (None, "x"), (None, "x")], "doc_id int, text string")
    rows = sorted((str(r.doc_id), r.TokenId, r.Text, r.BeginOffset, r.EndOffset) for r in tx.tokens_with_offsets(docs).collect())
    assert [r[:3] for r in rows] == [("1", 1, "ab"), ("1", 2, "ab"), ("1", 3, "cd"), ("1", 4, "cd"), ("2", 1, "ef"), ("None", 1, "x"), ("None", 2, "x")]
    assert rows[0][3:] == (0, 2) and rows[3][3:] == (8, 10)


def test_a_large_lexicon_is_not_sent_to_every_task(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "ab ab x"), (2, "x"), (3, None)], "doc_id int, text string")
    lexicon = spark.createDataFrame([("ab", 1.0), ("x", -1.0), ("y", 0.1)], "word string, polarity double")
    small = sorted(map(str, tx.sentiment(docs, lexicon).collect()))
    monkeypatch.setattr(tx, "SENT_WORDS", 1)
    assert sorted(map(str, tx.sentiment(docs, lexicon).collect())) == small and "POSITIVE" in small[0]


def test_block_products_are_dealt_over_tasks_and_ties_go_to_the_smaller_id(spark):
    frame = lambda rows: spark.createDataFrame(rows, "id int, features array<float>")
    users, items = frame([(u, [1.0, float(u)]) for u in range(5)]), frame([(i, [float(i % 3), 0.0]) for i in range(24)])
    df = rs.block_top(users, items, 3, 2, 4)
    assert sorted((r.u, r["rank"], r.i, r.score) for r in df.collect()) == [(u, n + 1, i, 2.0) for u in range(5) for n, i in enumerate((2, 5, 8))]
    assert "REPARTITION_BY_NUM" in plan(df)                # not merged into one task for being small


def test_top_lists_of_a_model_come_from_its_factors(spark, monkeypatch):
    """No cross join in Spark ML: balls that can't reach a list are left out, and the lists stay exact."""
    rng = np.random.default_rng(4)
    u, v = rng.normal(size=(40, 5)).astype(np.float32), rng.normal(size=(150, 5)).astype(np.float32)
    u[3], v[17], v[90] = 0, v[5], v[5]                             # ties
    factors = lambda a: spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(a)], "id int, features array<float>")
    model = SimpleNamespace(userFactors=factors(u), itemFactors=factors(v))
    uid = spark.createDataFrame([(1000 + i, i) for i in range(40)], "USER_ID long, __u int")
    iid = spark.createDataFrame([(5000 + i, i) for i in range(150)], "ITEM_ID long, __i int")
    top = rs.block_top
    monkeypatch.setattr(rs, "BALL", 8)
    monkeypatch.setattr(rs, "block_top", lambda *a, **b: top(*a, 16, 64, **b))
    score = u.astype(float) @ v.astype(float).T
    for got, s, first, second in ((rs.recommend_batch(model, uid, iid, uid, 4), score, "USER_ID", "ITEM_ID"), (rs.segment_users(model, uid, iid, iid, 4), score.T, "ITEM_ID", "USER_ID")):
        offset = {"USER_ID": 1000, "ITEM_ID": 5000}
        rows = {(r[first] - offset[first], r["rank"]): (r[second] - offset[second], r.score) for r in got.collect()}
        assert len(rows) == 4 * len(s)
        for a in range(len(s)):
            best = np.lexsort((np.arange(s.shape[1]), -s[a]))[:4]
            assert [rows[a, r][0] for r in range(1, 5)] == best.tolist()
            assert np.allclose([rows[a, r][1] for r in range(1, 5)], s[a][best], rtol=1e-6)


def test_few_products_are_taken(spark, tmp_path):
    rng = np.random.default_rng(5)
    u, v = rng.normal(size=(50, 4)).astype(np.float32), rng.normal(size=(4000, 4)).astype(np.float32)
    items = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id int, features array<float>")
    items.select("id", "features", F.lit(0).alias("block")).groupBy("block") \
        .applyInArrow(rs._ball_blocks(50, np.float32), "ids binary, factors binary, sizes binary, centres binary, radii binary").write.parquet(f"file://{tmp_path}/balls")

    class Counted(rs._BestOf):
        rows = 0

        def add(self, rows, ids, scores):
            Counted.rows += len(rows)
            super().add(rows, ids, scores)

    own, rs._BestOf = rs._BestOf, Counted
    try:
        best = rs._search(u, f"file://{tmp_path}/balls", np.float32, 3)
    finally:
        rs._BestOf = own
    assert (best.ids == np.argsort(-(u.astype(float) @ v.astype(float).T), axis=1)[:, :3]).all()
    assert Counted.rows < u.shape[0] * v.shape[0] / 50


def test_new_items_mark_the_candidates_without_copies_for_salts(spark):
    day = 86400
    inter = spark.createDataFrame([(1, 10, 0), (2, 10, 90 * day), (1, 20, 80 * day), (2, 30, 90 * day)], "USER_ID long, ITEM_ID long, TIMESTAMP long")
    cands = spark.createDataFrame([(1, 10, 0.5), (1, 20, 0.25), (2, 10, 0.5), (2, None, 0.1)], "USER_ID long, ITEM_ID long, score double")
    df = rs.explore(cands, inter, 0.5, 30, 3)
    assert sorted((r.USER_ID, r["rank"], r.ITEM_ID, r.score) for r in df.where("ITEM_ID is not null").collect()) == \
        [(1, 1, 20, 0.625), (1, 2, 30, 0.5), (1, 3, 10, 0.25), (2, 1, 20, 0.5), (2, 2, 30, 0.5), (2, 3, 10, 0.25)]
    assert "__salt" not in plan(df)
