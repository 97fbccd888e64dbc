"""Sinks (SNK1-SNK4). Writes are the only actions in the library."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .readers import scratch_path


def _fs(spark, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_single_csv(df: DataFrame, dest_file: str, header: bool = True) -> str:
    """SNK1. One CSV file at a fixed name: write one part to a temporary folder next to the
    target, rename the part, remove the folder. Only for small outputs (one task writes it)."""
    spark = df.sparkSession
    tmp = dest_file.rstrip("/") + ".__tmp"
    df.coalesce(1).write.mode("overwrite").option("header", header).csv(tmp)
    fs, tmp_p = _fs(spark, tmp)
    parts = [s.getPath() for s in fs.listStatus(tmp_p) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file, found {len(parts)}")
    _, dest = _fs(spark, dest_file)
    if fs.exists(dest):
        fs.delete(dest, False)
    if not fs.rename(parts[0], dest):
        raise RuntimeError(f"rename to {dest_file} failed")
    fs.delete(tmp_p, True)
    return dest_file


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> str:
    """SNK2. Snappy Parquet, written in parallel."""
    w = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_json_results(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """SNK3. JSON lines."""
    df.write.mode(mode).json(path)
    return path


def export(df: DataFrame, dest: str, kind: str, mode: str = "append") -> str:
    """SNK4. Export a result kind (backtest / forecast / explainability) under ``dest/kind=<kind>``."""
    from pyspark.sql import functions as F

    df.withColumn("kind", F.lit(kind)).write.mode(mode).partitionBy("kind").option("header", True).csv(dest)
    return dest


__all__ = ["write_single_csv", "write_parquet", "write_json_results", "export", "scratch_path"]
