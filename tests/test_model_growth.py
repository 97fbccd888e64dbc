"""The fit and the top lists of recommender models on larger tables: bounded tasks, few products."""

import numpy as np
from pyspark.sql import functions as F

from flowlab.operators import recsys as rs


def test_a_query_begins_with_the_ball_that_promises_most_in_all_blocks(spark, tmp_path, monkeypatch):
    """Items grow longer from block to block: taken in order, each block would replace the lists of the one before."""
    rng = np.random.default_rng(7)
    u, v = rng.random((60, 4)).astype(np.float32), rng.random((2000, 4)).astype(np.float32)
    v *= (1 + np.arange(2000) // 100)[:, None].astype(np.float32)
    v[1950:1960] = v[1940]                                         # ties
    items = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id int, features array<float>")
    items.select("id", "features", F.expr("id div 100").alias("block")).repartitionByRange(20, "block").groupBy("block") \
        .applyInArrow(rs._ball_blocks(25, np.float32), "ids binary, factors binary, sizes binary, centres binary, radii binary").write.parquet(f"file://{tmp_path}/balls")
    taken = []
    add = rs._BestOf.add
    monkeypatch.setattr(rs._BestOf, "add", lambda self, rows, ids, scores: taken.append(len(rows)) or add(self, rows, ids, scores))
    best = rs._search(u, f"file://{tmp_path}/balls", np.float32, 5)
    score = u.astype(float) @ v.astype(float).T
    assert best.ids.tolist() == [np.lexsort((np.arange(2000), -s))[:5].tolist() for s in score]
    assert sum(taken) < 60 * 5 * 4                                 # a few lists' worth for each query


def test_few_requests_occupy_all_cores(spark):
    factors = lambda n: spark.range(n).select(F.col("id").cast("int"), F.array(F.rand(1).cast("float"), F.rand(2).cast("float")).alias("features"))
    df = rs.block_top(factors(3 * rs.QUERY_ROWS), factors(40), 3)
    assert df.count() == 9 * rs.QUERY_ROWS
    assert df.rdd.getNumPartitions() == min(3, spark.sparkContext.defaultParallelism)


def test_blocks_of_a_fit_follow_the_counts(spark, monkeypatch):
    from pyspark.ml.recommendation import ALS

    seen = []
    fit = ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, data: seen.append((self.getNumUserBlocks(), self.getNumItemBlocks())) or fit(self, data))
    inter = spark.createDataFrame([(u, i) for u in range(12) for i in range(10)], "USER_ID long, ITEM_ID long")
    rs.train_recommender(inter, rank=2, max_iter=1)
    monkeypatch.setattr(rs, "BLOCK_COUNTS", 9)
    model, uid, iid = rs.train_recommender(inter, rank=2, max_iter=2)
    assert seen == [(10, 10), (14, 14)]                            # small tables: as Spark ML has it
    assert rs.recommend_batch(model, uid, iid, inter, 3).count() == 36
