"""Sort, limit, sampling and partitioning (SMP1-SMP6, PRT1).

Every "random" operator has a stable twin ordered by ``md5(seed:id)``: the same rows come
out whatever the partitioning, on any engine, which is what makes it testable and
re-runnable after an executor loss. Top-n forms compile to TakeOrderedAndProject or to a
WindowGroupLimit that cuts each map task to n rows per group before the shuffle, so a
hot label never sends all of its rows to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stable_hash(id_col, seed) -> Column:
    """Hex md5 of ``seed:id`` (several id columns are joined by ``:``); identical in Spark and DuckDB."""
    if isinstance(id_col, (list, tuple)):
        key = F.concat_ws(":", *[F.col(c).cast("string") for c in id_col])
    else:
        key = F.col(id_col).cast("string")
    return F.md5(F.concat(F.lit(f"{seed}:"), key))


def fraction_threshold(fraction: float) -> str:
    """8 hex digits t such that P(substr(md5, 1, 8) < t) = fraction."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    v = min(int(round(fraction * 2 ** 32)), 2 ** 32)
    return "g" if v >= 2 ** 32 else f"{v:08x}"      # 'g' sorts after every hex digit


def latest_events(df: DataFrame, ts: str, n: int, tie: str | None = None) -> DataFrame:
    """SMP1. Newest n rows (TakeOrderedAndProject: per-partition top n, no full sort)."""
    order = [F.col(ts).desc()] + ([F.col(tie).desc()] if tie else [])
    return df.orderBy(*order).limit(n)


def stratified_exact_sample(df: DataFrame, label: str, counts: dict, seed: int = 0,
                            id_col: str | None = None, stable: bool = True) -> DataFrame:
    """SMP2. Exactly min(n, available) rows per label value, in one pass: the rank of a row in
    its label by a stable hash is compared with the label's count (the limit on the rank is
    applied in each map task before the shuffle).

    ``stable`` orders by md5(seed:id) (needs ``id_col``); otherwise by ``rand(seed)`` like
    ``ORDER BY RAND() LIMIT n``.
    """
    if stable and id_col is None:
        raise ValueError("stable sampling needs id_col")
    wanted = df.filter(F.col(label).isin(list(counts)))
    if not counts:
        return wanted
    n = None
    for value, k in counts.items():
        n = (F.when if n is None else n.when)(F.col(label) == F.lit(value), F.lit(int(k)))
    order = [stable_hash(id_col, seed), F.col(id_col)] if stable else [F.rand(seed)]
    w = Window.partitionBy(label).orderBy(*order)
    return wanted.withColumn("__rn", F.row_number().over(w)) \
        .filter((F.col("__rn") <= max(map(int, counts.values()))) & (F.col("__rn") <= n)).drop("__rn")


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 0, id_col: str | None = None) -> DataFrame:
    """SMP3. Without replacement. With ``id_col``: hash form, independent of partitioning;
    without: ``DataFrame.sample`` (depends on partitioning)."""
    if id_col is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df.filter(F.substring(stable_hash(id_col, seed), 1, 8) < F.lit(fraction_threshold(fraction)))


def take_per_class(df: DataFrame, label: str, n: int, order_col: str) -> DataFrame:
    """SMP4. First n rows per class by ``order_col`` (WindowGroupLimit before the shuffle)."""
    w = Window.partitionBy(label).orderBy(F.col(order_col))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def random_pick(df: DataFrame, label: str, id_col: str, n: int = 10, seed: int = 0) -> DataFrame:
    """SMP5. n draws: a class uniformly at random, then a member of it uniformly at random.

    Each class is expanded to the n draw numbers (no join), the class pick is a grouped
    min-by over n groups, and the member pick joins the n picked classes (a table of n rows)
    and takes a grouped min-by, so partial aggregation keeps per-task state at n rows.
    """
    classes = df.select(label).distinct()
    per_draw = classes.select(label, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("draw"))
    pick_c = per_draw.groupBy("draw").agg(
        F.min_by(label, F.md5(F.concat(F.lit(f"{seed}:c:"), F.col("draw").cast("string"), F.lit(":"),
                                       F.col(label).cast("string")))).alias(label))        # n rows
    j = df.join(F.broadcast(pick_c), label)
    h = F.md5(F.concat(F.lit(f"{seed}:f:"), F.col("draw").cast("string"), F.lit(":"), F.col(id_col).cast("string")))
    return j.groupBy("draw", label).agg(F.min_by(id_col, h).alias(id_col))


def holdout_split(df: DataFrame, fraction: float, id_col: str, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """SMP6. Stable (train, holdout) split by md5 bucket; ``fraction`` goes to holdout."""
    t = F.lit(fraction_threshold(fraction))
    b = F.substring(stable_hash(id_col, seed), 1, 8)
    return df.filter(b >= t), df.filter(b < t)


def repartition_for_join(df: DataFrame, n: int | None = None, *keys: str) -> DataFrame:
    """PRT1. Hash-partition on the join keys (AQE may still coalesce small partitions)."""
    if n is None:
        return df.repartition(*keys)
    return df.repartition(n, *keys) if keys else df.repartition(n)
