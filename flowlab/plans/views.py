"""Domain views over the shared test tables.

Each view exists twice: as a DataFrame builder (what the operators consume) and as a SQL
text for the DuckDB oracle. Both must describe the same rows and columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card-transaction shaped rows as a crawler would type them (timestamp still text)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.select(
        F.col("o_orderkey").alias("index"),
        F.col("o_orderdate").cast("string").alias("trans_date_trans_time"),
        F.col("c_custkey").alias("cc_num"),
        F.col("o_orderpriority").alias("merchant"),
        F.col("c_mktsegment").alias("category"),
        (F.col("o_totalprice") / 500).alias("amt"),
        F.col("c_name").alias("first"),
        F.col("n_name").alias("state"),
        F.col("c_nationkey").cast("bigint").alias("zip"),
        F.col("c_acctbal").alias("lat"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("unix_time"),
        F.col("o_orderkey").cast("string").alias("trans_num"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("is_fraud"),
    )


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long time series (item_id, timestamp, target_value)."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("p_brand").alias("item_id"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_quantity").alias("target_value"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit ratings (userId, movieId, rating, timestamp epoch s) + order priority as context."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        (F.col("l_quantity") / 10).alias("rating"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("timestamp"),
        F.col("o_orderpriority").alias("context"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item catalogue (movieId, title 'Name (year)', genres 'A|B')."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("movieId"),
        F.concat(F.col("p_name"), F.lit(" ("), (F.col("p_size") + 1970).cast("string"), F.lit(")")).alias("title"),
        F.concat(F.col("p_type"), F.lit("|"), F.col("p_brand")).alias("genres"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


# SQL twins, used as CTEs by the oracle queries.
SQL_VIEWS = {
    "transactions_raw": """
        SELECT o_orderkey AS "index",
               CAST(o_orderdate AS VARCHAR) AS trans_date_trans_time,
               c_custkey AS cc_num, o_orderpriority AS merchant, c_mktsegment AS category,
               o_totalprice / 500 AS amt, c_name AS "first", n_name AS state,
               CAST(c_nationkey AS BIGINT) AS zip, c_acctbal AS lat,
               CAST(floor(epoch(o_orderdate)) AS BIGINT) AS unix_time,
               CAST(o_orderkey AS VARCHAR) AS trans_num,
               CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS is_fraud
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "demand": """
        SELECT p_brand AS item_id, l_shipdate AS "timestamp", l_quantity AS target_value
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "ratings": """
        SELECT o_custkey AS userId, l_partkey AS movieId, l_quantity / 10 AS rating,
               CAST(floor(epoch(o_orderdate)) AS BIGINT) AS "timestamp", o_orderpriority AS context
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "items": """
        SELECT p_partkey AS movieId, p_name || ' (' || CAST(p_size + 1970 AS VARCHAR) || ')' AS title,
               p_type || '|' || p_brand AS genres
        FROM part""",
}


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with ``WITH name AS (...)`` for the named views (and extra CTEs, in order)."""
    parts = [f"{n} AS ({SQL_VIEWS[n]})" for n in names]
    parts += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    if not parts:
        return sql
    return "WITH " + ",\n".join(parts) + "\n" + sql
