"""Filters and predicates (FLT1-FLT7). All are plain comparisons so that Parquet can prune."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def time_cutoff_split(df: DataFrame, ts: str, train_max, test_min) -> tuple[DataFrame, DataFrame]:
    """FLT1. Strict on both sides (Q1): train ``ts < train_max``, test ``ts > test_min``."""
    if str(train_max) > str(test_min):
        raise ValueError("train_max must not be after test_min (splits would overlap)")
    c = F.col(ts)
    return df.filter(c < F.lit(train_max).cast(df.schema[ts].dataType)), \
        df.filter(c > F.lit(test_min).cast(df.schema[ts].dataType))


def year_range(df: DataFrame, col: str, lo: int, hi: int, inclusive: bool = False) -> DataFrame:
    """FLT2. Rows whose year is in (lo, hi) — or [lo, hi] with ``inclusive`` (Q2).

    Written as a range on the column itself rather than ``year(col)`` so the bound reaches
    the Parquet reader as a pushed filter (row-group and partition pruning).
    """
    lo, hi = int(lo), int(hi)
    if lo >= hi and not (inclusive and lo == hi):
        raise ValueError(f"year range needs lo < hi, got {lo}, {hi}")
    first = lo if inclusive else lo + 1
    end = hi + 1 if inclusive else hi        # exclusive upper year
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.StringType):     # ISO 'yyyy-MM-dd...' text sorts like dates
        return df.filter((c >= F.lit(f"{first:04d}-01-01")) & (c < F.lit(f"{end:04d}-01-01")))
    if isinstance(dtype, T.DateType):
        return df.filter((c >= F.lit(dt.date(first, 1, 1))) & (c < F.lit(dt.date(end, 1, 1))))
    lo_ts = F.lit(f"{first:04d}-01-01 00:00:00").cast(dtype)
    hi_ts = F.lit(f"{end:04d}-01-01 00:00:00").cast(dtype)
    return df.filter((c >= lo_ts) & (c < hi_ts))


def label_in(df: DataFrame, col: str, labels) -> DataFrame:
    """FLT3."""
    return df.filter(F.col(col).isin(list(labels)))


def score_band(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """FLT4. Closed band ``lo <= s <= hi`` (Q6)."""
    return df.filter(F.col(col).between(lo, hi))


def successful_only(df: DataFrame, error_col: str = "error") -> DataFrame:
    """FLT5."""
    return df.filter(F.col(error_col).isNull())


def query_forecast(df: DataFrame, filters: dict) -> DataFrame:
    """FLT6. Conjunction of equality filters over attributes."""
    cond = F.lit(True)
    for k, v in filters.items():
        cond = cond & (F.col(k) == F.lit(v))
    return df.filter(cond)


def min_confidence(df: DataFrame, col: str, threshold: float, label_col: str | None = None) -> DataFrame:
    """FLT7. Without ``label_col``: drop rows under the threshold. With it: keep the row and
    null the label ("no label detected")."""
    if label_col is None:
        return df.filter(F.col(col) >= threshold)
    return df.withColumn(label_col, F.when(F.col(col) >= threshold, F.col(label_col)))
