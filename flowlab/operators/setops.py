"""Set operations and SQL entry points (SET1, SQL1, SQL2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spark_union(a: DataFrame, b: DataFrame, kind: str = "UNION ALL", by_name: bool = False) -> DataFrame:
    """SET1. ``UNION ALL`` keeps duplicates, ``UNION`` removes them. By position unless ``by_name``."""
    k = " ".join(kind.upper().split())
    if k not in ("UNION", "UNION ALL"):
        raise ValueError(f"unknown union kind {kind!r}")
    u = a.unionByName(b) if by_name else a.union(b)
    return u.distinct() if k == "UNION" else u


def sql_query(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """SQL1. ``spark.sql`` with DataFrames bound by name (``{alias}`` in the text); no
    global view names are created."""
    return spark.sql(query, **frames)


def split_statements(text: str) -> list[str]:
    """Split a script on ``;`` outside single-quoted literals, dropping ``--`` line comments;
    trim; drop empty parts."""
    out, cur, quoted, i = [], [], False, 0
    while i < len(text):
        ch = text[i]
        if not quoted and text.startswith("--", i):
            j = text.find("\n", i)
            i = len(text) if j < 0 else j
            continue
        if ch == "'":
            quoted = not quoted
        if ch == ";" and not quoted:
            out.append("".join(cur))
            cur = []
        else:
            cur.append(ch)
        i += 1
    out.append("".join(cur))
    return [s.strip() for s in out if s.strip()]


def run_sql_script(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """SQL2. Run statements in order (DDL and queries); return the last result."""
    last = None
    for stmt in split_statements(text):
        last = spark.sql(stmt, **frames) if frames else spark.sql(stmt)
    return last
