"""Tier 3: properties of the operators on generated and shared data."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowlab.operators import recsys as rs
from flowlab.operators.ranking import dense_index, rank_within_group
from flowlab.operators.sampling import fraction_threshold, stratified_exact_sample

from .conftest import SF_SMALL


def test_rank_within_group_matches_window_on_skew(spark):
    # one group holds most rows
    df = spark.range(0, 5000).select(F.when(F.col("id") % 10 < 7, F.lit(0)).otherwise(F.col("id") % 13).alias("g"),
                                     ((F.col("id") * 7919) % 5003).alias("t"), F.col("id"))
    a = rank_within_group(df, "g", ["t", "id"], n_partitions=16)
    w = Window.partitionBy("g").orderBy("t", "id")
    b = df.withColumn("rk", F.row_number().over(w)).withColumn("sz", F.count(F.lit(1)).over(Window.partitionBy("g")))
    j = a.join(b, "id")
    assert j.filter((F.col("__rank") != F.col("rk")) | (F.col("__size") != F.col("sz"))).count() == 0
    assert j.count() == 5000


def test_dense_index(spark):
    df = spark.range(0, 3000).select((F.col("id") * 3 % 1001).alias("k"))
    d = dense_index(df, "k", "ix", n_partitions=7).collect()
    assert sorted(r["ix"] for r in d) == list(range(1001))


def test_strata_sizes(spark):
    df = spark.range(0, 100).select("id", F.when(F.col("id") < 5, "a").otherwise("b").alias("lab"))
    s = stratified_exact_sample(df, "lab", {"a": 12, "b": 30, "c": 3}, seed=1, id_col="id")
    c = {r["lab"]: r["count"] for r in s.groupBy("lab").count().collect()}
    assert c == {"a": 5, "b": 30}


def test_fraction_threshold():
    assert fraction_threshold(0.0) == "00000000" and fraction_threshold(1.0) == "g"
    assert int(fraction_threshold(0.25), 16) == 2 ** 30


def test_ndcg_bounds_and_softmax(spark):
    inter = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        F.col("l_partkey").alias("ITEM_ID"), (F.col("l_orderkey") % 50).alias("USER_ID"), F.col("l_linenumber").cast("long").alias("TIMESTAMP")).distinct()
    s = rs.evaluate_split(inter, test_fraction=0.3)
    recs = rs.recommend_popular(s["train"], s["test_truth"], 25)
    m = rs.ranking_metrics(recs, s["test_truth"]).first().asDict()
    assert all(0.0 <= v <= 1.0 for v in m.values())
    n = rs.normalise_scores(recs).groupBy("USER_ID").agg(F.sum("score").alias("s")).collect()
    assert all(math.isclose(r["s"], 1.0, rel_tol=1e-9) for r in n)
    # input and truth partition each test user's events
    assert s["test_input"].join(s["test_truth"], ["USER_ID", "ITEM_ID", "TIMESTAMP"]).count() == 0
