"""Registered queries for the generic operators: sources and sinks round trips, projections,
filters, sampling, set operations and SQL entry points."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import fraud as fr
from ..operators.aggregates import class_balance, stage_counts
from ..operators.filters import score_band, time_cutoff_split
from ..operators.mapping import (copy_column, event_envelope, parse_event_payload, rename_field)
from ..operators.sampling import latest_events, stratified_exact_sample
from ..operators.setops import run_sql_script, spark_union, sql_query
from ..sources import readers as rd
from ..sources import sinks as sk
from .q_fraud import (EVENTS_SQL, SCORED_SQL, TEST_MIN, TEST_SAMPLE_SQL, TRAIN_MAX, TRAIN_SQL, events, prepared,
                      scored)
from .registry import register
from .views import SQL_VIEWS, table, transactions_raw, with_views

RAW_DDL = ("`index` bigint, trans_date_trans_time string, cc_num bigint, merchant string, category string, amt double, "
           "`first` string, state string, zip bigint, lat double, unix_time bigint, trans_num string, is_fraud bigint")
RAW_SQL = with_views("SELECT * FROM transactions_raw", "transactions_raw")
RAW_NAMES = [c.split()[0].strip("`") for c in RAW_DDL.split(", ")]


# ---- sources and sinks -----------------------------------------------------------------------------
@register("src1_snk1_single_csv_round_trip", RAW_SQL)
def q_csv(spark, sf):
    """SRC1 over a parallel write. SNK1's single file is for bounded results only, see below."""
    path = rd.scratch_path(spark, "csv")
    transactions_raw(spark, sf).write.option("header", True).option("escape", '"').csv(path)
    return rd.read_csv(spark, path, RAW_DDL)


@register("snk1_single_csv_of_test_sample", f"SELECT trans_num, amt FROM ({TEST_SAMPLE_SQL}) s")
def q_single_csv(spark, sf):
    """The one-file sink on the test sample, whose size the strata's counts bound."""
    path = rd.scratch_path(spark, "single") + "/sample.csv"
    sk.write_single_csv(prepared(spark, sf)["test_sample"].select("trans_num", "amt"), path)
    return rd.read_csv(spark, path, "trans_num string, amt double")


@register("src2_read_table", RAW_SQL)
def q_read_table(spark, sf):
    """A scan of a catalog table over files of the shared folder."""
    name, path = "tx_" + uuid.uuid4().hex[:8], rd.scratch_path(spark, "catalog")
    transactions_raw(spark, sf).write.parquet(path)
    spark.catalog.createTable(name, path=path, source="parquet")
    return rd.read_table(spark, "default", name)


@register("src3_register_csv_table", RAW_SQL)
def q_csv_table(spark, sf):
    base = rd.scratch_path(spark, "csvtable")
    raw = transactions_raw(spark, sf)
    raw.filter(F.col("trans_date_trans_time") < TRAIN_MAX).write.option("header", True).csv(base + "/train")
    raw.filter(F.col("trans_date_trans_time") >= TRAIN_MAX).write.option("header", True).csv(base + "/test")
    return rd.register_csv_table(spark, "tx_" + uuid.uuid4().hex[:8], base, RAW_DDL)


@register("src4_read_csv_inferred", with_views("""
SELECT * REPLACE (CAST("index" AS INTEGER) AS "index", CAST(trans_date_trans_time AS TIMESTAMP) AS trans_date_trans_time, CAST(cc_num AS INTEGER) AS cc_num,
                  CAST(zip AS INTEGER) AS zip, CAST(unix_time AS INTEGER) AS unix_time, CAST(trans_num AS INTEGER) AS trans_num, CAST(is_fraud AS INTEGER) AS is_fraud)
FROM transactions_raw""", "transactions_raw"))
def q_inferred(spark, sf):
    path = rd.scratch_path(spark, "inferred")
    transactions_raw(spark, sf).write.option("header", True).csv(path)
    return rd.read_csv_inferred(spark, path)


@register("src5_read_csv_matching", RAW_SQL)
def q_matching(spark, sf):
    base = rd.scratch_path(spark, "matching")
    raw = transactions_raw(spark, sf)
    raw.write.option("header", True).csv(base + "/kept")
    raw.limit(0).write.option("header", True).json(base + "/other")           # other formats beside it are not matched
    return rd.read_csv_matching(spark, base, RAW_DDL, ".csv", r"^part-\d+-")


@register("src10_create_external_table", with_views("SELECT CAST(count(*) AS BIGINT) AS n FROM demand", "demand"))
def q_external(spark, sf):
    from .views import demand

    base = rd.scratch_path(spark, "external")
    demand(spark, sf).select("item_id", F.col("timestamp").cast("string"), "target_value") \
        .write.option("sep", "\t").csv(base)
    return rd.create_external_table(spark, "demand_" + uuid.uuid4().hex[:8], base,
                                    "item_id string, `timestamp` timestamp, target_value double", sep="\t")


@register("src11_latest_output", with_views("SELECT * REPLACE (amt + 1 AS amt) FROM transactions_raw", "transactions_raw"))
def q_latest(spark, sf):
    """Two runs over all transactions, many files each: the later one is read."""
    base = rd.scratch_path(spark, "runs")
    raw = transactions_raw(spark, sf)
    raw.write.option("header", True).csv(base + "/run1")
    raw.withColumn("amt", F.col("amt") + 1).write.option("header", True).csv(base + "/run2")
    return rd.latest_output(spark, base, "csv", RAW_DDL, whole_run=True, header="true", recursiveFileLookup="true")


@register("snk2_parquet_round_trip", RAW_SQL)
def q_parquet(spark, sf):
    path = rd.scratch_path(spark, "parquet")
    sk.write_parquet(transactions_raw(spark, sf), path, partition_by=["category"])
    return spark.read.parquet(path)


@register("snk3_json_round_trip", RAW_SQL)
def q_json(spark, sf):
    path = rd.scratch_path(spark, "json")
    sk.write_json_results(transactions_raw(spark, sf), path)
    return spark.read.schema(RAW_DDL).json(path)


@register("snk4_export", f"""
SELECT trans_num, EVENT_LABEL, 'train' AS kind FROM ({TRAIN_SQL}) a
UNION ALL SELECT trans_num, NULL AS EVENT_LABEL, 'test_sample' AS kind FROM ({TEST_SAMPLE_SQL}) b""")
def q_export(spark, sf):
    base = rd.scratch_path(spark, "export")
    p = prepared(spark, sf)
    sk.export(p["train"].select("trans_num", "EVENT_LABEL"), base, "train")
    sk.export(p["test_sample"].select("trans_num", F.lit(None).cast("string").alias("EVENT_LABEL")), base, "test_sample")
    return spark.read.option("header", True).schema("trans_num string, EVENT_LABEL string, kind string").csv(base)


def _filled_sql(source: str, names, tail) -> str:
    rows = ", ".join(f'''({i}, '{c}', (SELECT count("{c}") FROM t))''' for i, c in enumerate([n for n in names if n not in tail] + [n for n in tail if n in names]))
    return f"WITH t AS ({source}) SELECT CAST(pos AS INTEGER) AS pos, name, CAST(filled AS BIGINT) AS filled FROM (VALUES {rows}) v(pos, name, filled)"


def _filled(df):
    """Position, name and number of non-null values of every column, from one pass over the rows."""
    one = df.agg(*[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(df.columns)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("name"), F.col(f"n{i}").alias("filled"))
                                         for i, c in enumerate(df.columns)])))


@register("snk5_order_event_columns", _filled_sql(RAW_SQL, RAW_NAMES, ["category", "amt"]))
def q_order(spark, sf):
    """The raw columns with two of them put last, and how many rows fill each."""
    from ..operators.fraud import order_event_columns

    return _filled(order_event_columns(transactions_raw(spark, sf), ("category", "amt")))


# ---- projections --------------------------------------------------------------------------------------
@register("prj3_rename_field", with_views("SELECT trans_num, amt AS amount FROM transactions_raw", "transactions_raw"))
def q_rename(spark, sf):
    return rename_field(transactions_raw(spark, sf).select("trans_num", "amt"), "amt", "amount")


@register("prj4_copy_column", f"SELECT trans_num, EVENT_TIMESTAMP, EVENT_TIMESTAMP AS event_time FROM ({EVENTS_SQL}) e")
def q_copy(spark, sf):
    return copy_column(events(spark, sf).select("trans_num", "EVENT_TIMESTAMP"), "EVENT_TIMESTAMP", "event_time")


@register("prj7_event_envelope", f"""
SELECT trans_num, 'customer' AS ENTITY_TYPE, 'unknown' AS ENTITY_ID, trans_num AS EVENT_ID FROM ({EVENTS_SQL}) e""")
def q_envelope(spark, sf):
    return event_envelope(events(spark, sf).select("trans_num"), "customer")


_FLOW = "CASE WHEN category = 'AUTOMOBILE' THEN NULL ELSE 'fraud-review' END"


@register("prj10_parse_event_payload", f"""
SELECT trans_num, amt, cc_num, zip, category, coalesce(city, 'null') AS city, coalesce(city_pop, 0.0) AS city_pop,
       EVENT_TIMESTAMP, coalesce(flow, 'ignore') AS flow_definition
FROM (SELECT trans_num, CAST(amt AS DOUBLE) AS amt, CAST(cc_num AS DOUBLE) AS cc_num, CAST(zip AS VARCHAR) AS zip, category,
             CAST(NULL AS VARCHAR) AS city, CAST(NULL AS DOUBLE) AS city_pop,
             CAST(date_trunc('second', EVENT_TIMESTAMP) AS TIMESTAMP) AS EVENT_TIMESTAMP, {_FLOW} AS flow
      FROM ({EVENTS_SQL}) e) x""")
def q_payload(spark, sf):
    ev = events(spark, sf)
    payload = F.to_json(F.struct(
        F.struct(*[F.col(v).cast("string").alias(v) for v in ["trans_num", "amt", "cc_num", "zip", "category"]]).alias("variables"),
        F.date_format("EVENT_TIMESTAMP", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("EVENT_TIMESTAMP"),
        F.when(F.col("category") != "AUTOMOBILE", F.lit("fraud-review")).alias("flow_definition")))
    p = parse_event_payload(ev.select(payload.alias("payload")), "payload", fr.CARD_VARIABLES)
    return p.select("trans_num", "amt", "cc_num", "zip", "category", "city", "city_pop", "EVENT_TIMESTAMP", "flow_definition")


# ---- filters, aggregates, sampling --------------------------------------------------------------------
@register("flt1_time_cutoff_split", f"""
SELECT trans_num, 'train' AS split FROM ({EVENTS_SQL}) e WHERE EVENT_TIMESTAMP < TIMESTAMP '{TRAIN_MAX}'
UNION ALL SELECT trans_num, 'test' AS split FROM ({EVENTS_SQL}) e WHERE EVENT_TIMESTAMP > TIMESTAMP '{TEST_MIN}'""")
def q_cutoff(spark, sf):
    tr, te = time_cutoff_split(events(spark, sf), "EVENT_TIMESTAMP", TRAIN_MAX, TEST_MIN)
    return tr.select("trans_num", F.lit("train").alias("split")).unionByName(
        te.select("trans_num", F.lit("test").alias("split")))


@register("flt4_score_band", f"SELECT trans_num, fraud_model_insightscore FROM ({SCORED_SQL}) s WHERE fraud_model_insightscore BETWEEN 700 AND 900")
def q_band(spark, sf):
    return score_band(scored(spark, sf), "fraud_model_insightscore", 700, 900).select("trans_num", "fraud_model_insightscore")


@register("agg1_stage_counts", f"""
SELECT 'raw' AS stage, CAST(count(*) AS BIGINT) AS "rows" FROM ({RAW_SQL}) r
UNION ALL SELECT 'train', CAST(count(*) AS BIGINT) FROM ({TRAIN_SQL}) a
UNION ALL SELECT 'test_sample', CAST(count(*) AS BIGINT) FROM ({TEST_SAMPLE_SQL}) b""")
def q_stage_counts(spark, sf):
    p = prepared(spark, sf)
    return stage_counts({"raw": transactions_raw(spark, sf), "train": p["train"], "test_sample": p["test_sample"]})


@register("agg5_class_balance", f"""
SELECT split, EVENT_LABEL, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT 'train' AS split, EVENT_LABEL FROM ({EVENTS_SQL}) e WHERE EVENT_TIMESTAMP < TIMESTAMP '{TRAIN_MAX}'
  UNION ALL SELECT 'test' AS split, EVENT_LABEL FROM ({EVENTS_SQL}) e WHERE EVENT_TIMESTAMP > TIMESTAMP '{TEST_MIN}') x
GROUP BY ALL""")
def q_balance(spark, sf):
    tr, te = time_cutoff_split(events(spark, sf), "EVENT_TIMESTAMP", TRAIN_MAX, TEST_MIN)
    u = tr.withColumn("split", F.lit("train")).unionByName(te.withColumn("split", F.lit("test")))
    return class_balance(u, "EVENT_LABEL", "split")


@register("smp1_latest_events", "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 20")
def q_latest_events(spark, sf):
    return latest_events(table(spark, sf, "events"), "ts", 20, tie="event_id")


STRATA = {"click": 50, "view": 50, "purchase": 20, "error": 10, "signup": 5}


@register("smp2_stratified_exact_sample", f"""
SELECT event_id, event_type FROM (
  SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY md5('11:' || CAST(event_id AS VARCHAR)), event_id) AS rn
  FROM events) x
WHERE {" OR ".join(f"(event_type = '{k}' AND rn <= {v})" for k, v in STRATA.items())}""")
def q_strata(spark, sf):
    return stratified_exact_sample(table(spark, sf, "events").select("event_id", "event_type"), "event_type", STRATA,
                                   seed=11, id_col="event_id")


@register("smp2_stratified_random_sample")
def q_strata_random(spark, sf):
    return stratified_exact_sample(table(spark, sf, "events").select("event_id", "event_type"), "event_type", STRATA,
                                   seed=11, stable=False)


# ---- set operations and SQL -----------------------------------------------------------------------------
@register("set1_union_all", "SELECT event_type FROM events UNION ALL SELECT event_type FROM events WHERE value > 50")
def q_union_all(spark, sf):
    e = table(spark, sf, "events")
    return spark_union(e.select("event_type"), e.filter("value > 50").select("event_type"), "UNION ALL")


@register("set1_union_distinct", "SELECT user_id, event_type FROM events UNION SELECT user_id, 'any' FROM events")
def q_union(spark, sf):
    e = table(spark, sf, "events")
    return spark_union(e.select("user_id", "event_type"), e.select("user_id", F.lit("any").alias("event_type")), "UNION")


@register("sql1_sql_query", """
SELECT event_type, CAST(count(*) AS BIGINT) AS n, sum(value) AS total FROM events WHERE value > 10 GROUP BY event_type""")
def q_sql(spark, sf):
    return sql_query(spark, "SELECT event_type, CAST(count(*) AS BIGINT) AS n, sum(value) AS total FROM {e} "
                            "WHERE value > 10 GROUP BY event_type", e=table(spark, sf, "events"))


@register("sql2_run_sql_script", """
SELECT user_id, CAST(count(*) AS BIGINT) AS purchases FROM events WHERE event_type = 'purchase' GROUP BY user_id""")
def q_script(spark, sf):
    v = "ev_" + uuid.uuid4().hex[:8]
    table(spark, sf, "events").createOrReplaceTempView(v + "_src")
    script = f"""
      -- purchases per user; a ';' inside a literal does not split: 'a;b'
      CREATE OR REPLACE TEMP VIEW {v} AS SELECT * FROM {v}_src WHERE event_type = 'purchase' AND 'a;b' = 'a;b';
      SELECT user_id, CAST(count(*) AS BIGINT) AS purchases FROM {v} GROUP BY user_id;
    """
    return run_sql_script(spark, script)


__all__ = ["SQL_VIEWS"]
