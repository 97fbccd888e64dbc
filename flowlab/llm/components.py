"""Connected components of a link table by alternating large and small stars: every round is
two grouped minima and two joins, and the edge table shrinks towards one star per component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.session import cut_lineage

#: A hub may hold a large share of the edges: its rows are dealt over this many salts.
SALTS = 8


def _with_minimum(edges: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m): m is the smallest of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("mu"), F.least("u", "m").alias("m"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("ms"))
    return edges.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")) \
        .join(least, (F.col("u") == F.col("mu")) & (F.col("s") == F.col("ms"))).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _with_minimum(down)
    return near.select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .union(near.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b) of long identifiers -> (node, component): for every node with an edge,
    the smallest identifier it can reach. Self loops and rows with a null end are no links;
    repeated edges count once. Raises if ``max_rounds`` did not settle."""
    e = edges.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")) \
        .where("u <> v").distinct()
    last = None
    for _ in range(max_rounds):
        e = cut_lineage(_small_star(_large_star(e)))
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            tops = e.select(F.col("v").alias("node")).distinct()
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")) \
                .unionByName(tops.withColumn("component", F.col("node")))
        last = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
