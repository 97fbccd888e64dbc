"""Aggregations and de-duplication (AGG1-AGG5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

_AGGS = {"sum": F.sum, "mean": F.avg, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count,
         "first": F.min, "last": F.max}


def observe_count(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """AGG1 (no extra job). Row count collected as a side metric of the next action."""
    obs = Observation(stage)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def stage_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """AGG1 as a table: one (stage, rows) line per named frame, in one job."""
    out = None
    for name, df in frames.items():
        c = df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).select(F.lit(name).alias("stage"), "rows")
        out = c if out is None else out.unionByName(c)
    return out


def resample(series: DataFrame, freq: str = "day", agg: str = "sum", item: str = "item_id",
             ts: str = "timestamp", value: str = "target_value") -> DataFrame:
    """AGG2. Bucket a long series to a frequency (year/quarter/month/week/day/hour/minute).

    Partial aggregation runs before the shuffle, so a hot item costs one row per map task.
    """
    unit = {"Y": "year", "M": "month", "W": "week", "D": "day", "H": "hour", "min": "minute"}.get(freq, freq)
    bucket = F.date_trunc(unit, F.col(ts))
    bucket = bucket.cast(series.schema[ts].dataType)
    return series.groupBy(F.col(item).alias(item), bucket.alias(ts)).agg(_AGGS[agg](value).alias(value))


def drop_duplicate_rows(df: DataFrame, subset=None) -> DataFrame:
    """AGG3."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def detection_summary(df: DataFrame, truth: str = "label", pred: str = "predicted") -> DataFrame:
    """AGG4. correct / not detected (no label above threshold) / total."""
    return df.agg(
        F.count_if(F.col(pred) == F.col(truth)).cast("bigint").alias("correct"),
        F.count_if(F.col(pred).isNull()).cast("bigint").alias("below_threshold"),
        F.count(F.lit(1)).cast("bigint").alias("total"),
    )


def class_balance(df: DataFrame, label: str, split: str | None = None) -> DataFrame:
    """AGG5. Rows per label (and split)."""
    keys = [split, label] if split else [label]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
