"""Exact per-group running sums and ranks that stay balanced when one group holds a large
share of the rows.

``Window.partitionBy(group)`` sends a whole group to one task. Here rows are range
partitioned on (group, order...) instead, so a hot group is cut across many tasks; each
task computes running sums over its slice, and per-slice totals (one row per task and
group) give the offsets that turn local sums into global ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlab.session import cut_lineage


def _n(df: DataFrame, n: int | None) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def cumulative_within_group(df: DataFrame, group, order, value: str | None = None, n_partitions: int | None = None,
                            cum_col: str = "__cum", total_col: str = "__total") -> DataFrame:
    """Add the running sum of ``value`` (a running count when None) over ``order`` inside each
    group, including the current row, and the group total. ``order`` should make the order
    total; with ties the split between tasks decides which tied row counts first.

    The sliced rows are written to a reliable checkpoint once, so the rows and the slice totals
    read the very same slices: a sampled range exchange evaluated twice could cut differently."""
    group, order = list(group), list(order)
    v = F.col(value) if value else F.lit(1)
    s = cut_lineage(df.repartitionByRange(_n(df, n_partitions), *[F.col(c) for c in group + order])
                    .withColumn("__pid", F.spark_partition_id()))
    local = Window.partitionBy("__pid", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    slices = s.groupBy("__pid", *group).agg(F.sum(v).alias("__lsum"))          # one row per (task, group)
    before = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = slices.select(F.col("__pid").alias("__opid"), *[F.col(g).alias(f"__o_{g}") for g in group],
                         F.coalesce(F.sum("__lsum").over(before), F.lit(0)).alias("__off"),
                         F.sum("__lsum").over(Window.partitionBy(*group)).alias(total_col))
    cond = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__o_{g}")) for g in group],
                  F.col("__pid") == F.col("__opid"))
    out = s.withColumn("__lcum", F.sum(v).over(local)).join(offs, cond)
    return out.withColumn(cum_col, F.col("__off") + F.col("__lcum")) \
        .drop("__pid", "__opid", "__lcum", "__off", *[f"__o_{g}" for g in group])


def rank_within_group(df: DataFrame, group: str, order, n_partitions: int | None = None,
                      rank_col: str = "__rank", size_col: str = "__size") -> DataFrame:
    """1-based position of each row inside its group (``order`` must be total) and the group size."""
    out = cumulative_within_group(df, [group], order, None, n_partitions, rank_col, size_col)
    return out.withColumn(rank_col, F.col(rank_col).cast("bigint")).withColumn(size_col, F.col(size_col).cast("bigint"))


def dense_index(df: DataFrame, col: str, out: str, n_partitions: int | None = None) -> DataFrame:
    """Distinct values of ``col`` -> dense 0-based int index (``col``, ``out``), computed in
    parallel: range partition the distinct values, count per partition, prefix offsets."""
    d = cut_lineage(df.select(col).distinct().repartitionByRange(_n(df, n_partitions), col)
                    .withColumn("__pid", F.spark_partition_id()))
    d = d.withColumn("__lrank", F.row_number().over(Window.partitionBy("__pid").orderBy(col)))
    cnt = d.groupBy("__pid").agg(F.count(F.lit(1)).alias("__c"))   # <= n rows
    offs = cnt.select("__pid", F.coalesce(F.sum("__c").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    return d.join(F.broadcast(offs), "__pid").select(
        col, (F.col("__off") + F.col("__lrank") - 1).cast("int").alias(out))
