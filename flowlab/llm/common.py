"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words in every contract of this subpackage (fixed value).
SPACE_RUN = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def fold_of(doc_id, folds: int) -> int | None:
    """:func:`fold` in Python."""
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def byte_slices(column: pa.Array, limit: int = 3 << 20):
    """Runs of rows of a string column of about ``limit`` bytes, at least one row each, as
    (first, end, UTF-8 texts; null is empty), so that a task never holds the tokens of a whole
    Arrow batch."""
    column = column.cast(pa.binary())
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes.tolist(), start=1):
        total += n
        if total >= limit or i == len(sizes):
            yield start, i, [t or b"" for t in column.slice(start, i - start).to_pylist()]
            start, total = i, 0


def text_slices(column: pa.Array, limit: int = 3 << 20):
    """The runs of :func:`byte_slices` as (first, end, string array; null is empty)."""
    sizes = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)))
    start = 0
    while start < len(column):
        end = min(max(int(np.searchsorted(sizes, sizes[start] + limit)), start + 1), len(column))
        yield start, end, pc.fill_null(column.slice(start, end - start).cast(pa.string()), "")
        start = end
