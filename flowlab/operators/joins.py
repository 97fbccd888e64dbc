"""Joins (JOI1-JOI6).

No join here forces a broadcast of a side that grows with the data: Spark's planner
broadcasts on file statistics and AQE re-plans from real shuffle sizes, both under
``spark.sql.autoBroadcastJoinThreshold``, and falls back to a sort-merge join above it.
Lookup tables repeated for salts are always shuffled (``salted``).
Only frames built from driver-side parameter lists (bounded by construction) are hinted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Tasks that share the rows of a popular key.
SALTS = 16


def salted(lookup: DataFrame) -> DataFrame:
    """Every row of a lookup table once for each salt. The planner takes the copies for one row, so it
    would broadcast sixteen times what its threshold allows: the join is always a shuffled one."""
    return lookup.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")


def salt_of(*cols):
    """The salt that deals a row with a popular key by its other columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(SALTS)).cast("int")


def join_items_interactions(items: DataFrame, events: DataFrame, item_key: str, event_key: str) -> DataFrame:
    """JOI1. Inner equi join where keys differ in name and maybe type (cast to the events' type). An
    item may have a third of all events, so its events are dealt over salts."""
    et = events.schema[event_key].dataType
    it = salted(items.withColumn(item_key, F.col(item_key).try_cast(et)))
    ev = events.withColumn("__own", salt_of(*events.columns))
    return ev.join(it, (ev[event_key] == it[item_key]) & (ev["__own"] == it["__salt"]), "inner").drop("__own", "__salt")


def lookup_title(ids: DataFrame, items: DataFrame, id_col: str, item_key: str = "movieId",
                 fields=("title", "genres")) -> DataFrame:
    """JOI2. id -> title (and genre). Unknown ids are kept with null fields (left join); the rows of a
    popular id are dealt over salts."""
    lk = salted(items.select(F.col(item_key).alias("__k"), *fields))
    own = ids.withColumn("__own", salt_of(*ids.columns))
    return own.join(lk, (own[id_col] == lk["__k"]) & (own["__own"] == lk["__salt"]), "left").drop("__k", "__own", "__salt")


def enrich_ranked_list(df: DataFrame, key_col: str, list_col: str, items: DataFrame,
                       item_key: str, value_expr, out: str = "enriched") -> DataFrame:
    """JOI3. Array of ids -> array of looked-up values in the original order.

    ``value_expr`` is a Column over the ``items`` frame. Lists are short (top-k), so each
    regrouped row holds at most k elements; unknown ids keep their slot as null.
    """
    # a popular id is in very many lists: its rows are dealt over salts
    e = df.select(key_col, F.posexplode(list_col).alias("__pos", "__id"))
    lk = salted(items.select(F.col(item_key).cast(e.schema["__id"].dataType).alias("__k"), value_expr.alias("__v")))
    j = e.join(lk, (F.col("__id") == F.col("__k")) & (salt_of(key_col) == F.col("__salt")), "left")
    g = j.groupBy(key_col).agg(F.array_sort(F.collect_list(F.struct("__pos", "__v"))).alias("__s"))
    return g.select(key_col, F.transform("__s", lambda s: s["__v"]).alias(out))


def restrict_to_requests(model_output: DataFrame, requests: DataFrame, key: str,
                         request_key: str | None = None) -> DataFrame:
    """JOI4. Keep only rows whose key was requested (semi join)."""
    rk = request_key or key
    r = requests.select(F.col(rk).alias("__rk")).distinct()
    return model_output.join(r, model_output[key] == r["__rk"], "left_semi")


def attach_holidays(series: DataFrame, calendar: DataFrame, country: str, date_col: str = "timestamp",
                    out: str = "holiday") -> DataFrame:
    """JOI5. Left join a holiday calendar on (date, country). The calendar is generated from
    rules over the years of interest, so its size is bounded (#years x #rules)."""
    cal = calendar.filter(F.col("country") == country).select(
        F.col("ds").alias("__d"), F.col("holiday").alias(out))
    cal = cal.groupBy("__d").agg(F.min(out).alias(out))     # one name per day
    return series.join(F.broadcast(cal), F.to_date(F.col(date_col)) == F.col("__d"), "left").drop("__d")


def attach_review(predictions: DataFrame, verdicts: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """JOI6. Predictions with human verdicts (left join) and those still unanswered (anti join)."""
    answered = predictions.join(verdicts, key, "left")
    pending = predictions.join(verdicts.select(key), key, "left_anti")
    return answered, pending
