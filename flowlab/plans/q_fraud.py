"""Registered fraud queries (FRD*, and the projections/filters they are built from)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fraud as fr
from ..operators.joins import attach_review
from ..operators.mapping import apply_mapping, conform_variables, drop_fields, recode_label
from .registry import register
from .views import transactions_raw, with_views

# Cutoffs and sample sizes used by the registered fraud queries.
TRAIN_MAX = "1999-01-01 00:00:00"
TEST_MIN = "2000-06-30 00:00:00"
FRAUD_N, LEGIT_N = 12, 130
THRESHOLDS = [100, 200, 300, 400, 500, 600, 700, 800, 900]

# ---- SQL building blocks (DuckDB) -----------------------------------------------------------
_MAPPED_COLS = """
       TRY_CAST(trans_date_trans_time AS TIMESTAMP) AS trans_date_trans_time,
       TRY_CAST(cc_num AS BIGINT) AS cc_num, merchant, category, TRY_CAST(amt AS DOUBLE) AS amt,
       "first", CAST(NULL AS VARCHAR) AS "last", CAST(NULL AS VARCHAR) AS gender,
       CAST(NULL AS VARCHAR) AS street, CAST(NULL AS VARCHAR) AS city, state,
       TRY_CAST(zip AS BIGINT) AS zip, CAST(NULL AS INTEGER) AS city_pop, CAST(NULL AS VARCHAR) AS job,
       trans_num, TRY_CAST(is_fraud AS SMALLINT) AS is_fraud"""
_EXTRA_MAPPED = """, lat, CAST(NULL AS DOUBLE) AS "long", CAST(NULL AS DATE) AS dob,
       TRY_CAST(unix_time AS INTEGER) AS unix_time, CAST(NULL AS DOUBLE) AS merch_lat,
       CAST(NULL AS DOUBLE) AS merch_long"""
MAPPED_SQL = with_views(f"SELECT {_MAPPED_COLS} FROM transactions_raw", "transactions_raw")
EVENTS_SQL = f"""
SELECT * EXCLUDE (is_fraud, trans_date_trans_time), trans_date_trans_time AS EVENT_TIMESTAMP,
       CASE WHEN TRY_CAST(is_fraud AS INTEGER) = 0 THEN 'legit'
            WHEN TRY_CAST(is_fraud AS INTEGER) = 1 THEN 'fraud' END AS EVENT_LABEL
FROM ({MAPPED_SQL}) m"""
PROB_SQL = "1.0 / (1.0 + exp(-(amt - 500.0) / 100.0))"
SCORED_SQL = f"""
SELECT *, round(p_fraud * 1000, 0) AS fraud_model_insightscore
FROM (SELECT *, {PROB_SQL} AS p_fraud FROM ({EVENTS_SQL}) e) s"""
TRAIN_SQL = f"SELECT * FROM ({EVENTS_SQL}) e WHERE EVENT_TIMESTAMP < TIMESTAMP '{TRAIN_MAX}'"
TEST_SAMPLE_SQL = f"""
SELECT * EXCLUDE (EVENT_LABEL, rn) FROM (
  SELECT *, 'customer' AS ENTITY_TYPE, 'unknown' AS ENTITY_ID, trans_num AS EVENT_ID,
         row_number() OVER (PARTITION BY EVENT_LABEL ORDER BY md5('0:' || trans_num), trans_num) AS rn
  FROM ({EVENTS_SQL}) e WHERE EVENT_TIMESTAMP > TIMESTAMP '{TEST_MIN}') t
WHERE (EVENT_LABEL = 'fraud' AND rn <= {FRAUD_N}) OR (EVENT_LABEL = 'legit' AND rn <= {LEGIT_N})"""
AMOUNT_RULE_SQL = ("CASE WHEN amt > 900 THEN 'investigate' WHEN amt < 900 AND amt > 700 THEN 'review' "
                   "WHEN amt < 700 THEN 'approve' END")
AMOUNT_OUT_SQL = ("CASE WHEN amt > 900 THEN 'high_risk' WHEN amt < 900 AND amt > 700 THEN 'medium_risk' "
                  "WHEN amt < 700 THEN 'low_risk' END")
S = "fraud_model_insightscore"
SCORE_RULE_SQL = (f"CASE WHEN {S} > 900 THEN 'high_fraud_risk' WHEN {S} <= 900 AND {S} > 700 THEN "
                  f"'medium_fraud_risk' WHEN {S} <= 700 THEN 'low_fraud_risk' END")
SCORE_OUT_SQL = (f"CASE WHEN {S} > 900 THEN ['verify_customer'] WHEN {S} <= 900 AND {S} > 700 THEN ['review'] "
                 f"WHEN {S} <= 700 THEN ['approve'] ELSE []::VARCHAR[] END")
FLOW_SQL = "CASE WHEN category = 'AUTOMOBILE' THEN 'ignore' ELSE 'fraud-review' END"


# ---- Spark building blocks --------------------------------------------------------------------
def prob_col():
    """Deterministic stand-in for a model's fraud probability, computable by the oracle too."""
    return 1.0 / (1.0 + F.exp(-(F.col("amt") - 500.0) / 100.0))


def mapped(spark, sf):
    return drop_fields(apply_mapping(transactions_raw(spark, sf), fr.CARD_TRANSACTION_MAPPINGS),
                       fr.DROPPED_AFTER_MAPPING)


def events(spark, sf):
    m = mapped(spark, sf)
    m = m.withColumn("EVENT_TIMESTAMP", F.col("trans_date_trans_time")).withColumn("EVENT_LABEL", F.col("is_fraud"))
    return drop_fields(recode_label(m, "EVENT_LABEL", fr.LABELS), ["is_fraud", "trans_date_trans_time"])


def scored(spark, sf):
    return fr.insight_score(events(spark, sf).withColumn("p_fraud", prob_col()), "p_fraud")


def prepared(spark, sf):
    return fr.prepare_fraud(transactions_raw(spark, sf), TRAIN_MAX, TEST_MIN, FRAUD_N, LEGIT_N)


def flagship(spark, sf):
    """Raw transactions -> typed, labelled, cut-off split, stratified test sample -> routed by
    the ordered amount rules -> outcome counts."""
    s = fr.apply_rules(prepared(spark, sf)["test_sample"], fr.AMOUNT_RULES)
    return s.groupBy("rule_id", F.get("outcomes", F.lit(0)).alias("outcome")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.sum("amt").alias("amount"))


register("frd_flagship_outcomes", f"""
SELECT {AMOUNT_RULE_SQL} AS rule_id, {AMOUNT_OUT_SQL} AS outcome, CAST(count(*) AS BIGINT) AS n, sum(amt) AS amount
FROM ({TEST_SAMPLE_SQL}) s GROUP BY ALL""")(flagship)


@register("prj1_apply_mapping", with_views(f"SELECT {_MAPPED_COLS} {_EXTRA_MAPPED} FROM transactions_raw",
                                           "transactions_raw"))
def q_apply_mapping(spark, sf):
    return apply_mapping(transactions_raw(spark, sf), fr.CARD_TRANSACTION_MAPPINGS)


@register("prj2_drop_fields", MAPPED_SQL)
def q_drop_fields(spark, sf):
    return mapped(spark, sf)


@register("prj6_recode_label", f"SELECT trans_num, EVENT_LABEL FROM ({EVENTS_SQL}) e")
def q_recode_label(spark, sf):
    return events(spark, sf).select("trans_num", "EVENT_LABEL")


@register("frd1_prepare_train", TRAIN_SQL)
def q_prepare_train(spark, sf):
    return prepared(spark, sf)["train"]


@register("frd1_prepare_test_sample", TEST_SAMPLE_SQL)
def q_prepare_test_sample(spark, sf):
    return prepared(spark, sf)["test_sample"]


@register("frd2_model_variables")
def q_model_variables(spark, sf):
    """The training table's variables with the rows that fill each and its distinct values."""
    train = prepared(spark, sf)["train"]
    names = fr.model_variables(train)
    one = train.agg(*[x for i, c in enumerate(names) for x in (F.count(f"`{c}`").alias(f"n{i}"), F.approx_count_distinct(f"`{c}`").alias(f"d{i}"))])
    return one.select(F.inline(F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("variable"), F.col(f"n{i}").alias("filled"),
                                                  F.col(f"d{i}").alias("about_distinct")) for i, c in enumerate(names)])))


@register("frd4_insight_score", f"SELECT trans_num, amt, {S} FROM ({SCORED_SQL}) s")
def q_insight_score(spark, sf):
    return scored(spark, sf).select("trans_num", "amt", S)


@register("frd5_rules_first_matched", f"""
SELECT trans_num, {S}, {SCORE_RULE_SQL} AS rule_id, {SCORE_OUT_SQL} AS outcomes FROM ({SCORED_SQL}) s""")
def q_rules_first(spark, sf):
    return fr.apply_rules(scored(spark, sf).select("trans_num", S), fr.SCORE_RULES)


@register("frd5_rules_all_matched", f"""
SELECT trans_num, amt,
  list_filter([CASE WHEN amt > 900 THEN 'investigate' END, CASE WHEN amt < 900 AND amt > 700 THEN 'review' END,
               CASE WHEN amt < 700 THEN 'approve' END], lambda x: x IS NOT NULL) AS rule_ids,
  flatten([CASE WHEN amt > 900 THEN ['high_risk'] ELSE []::VARCHAR[] END,
           CASE WHEN amt < 900 AND amt > 700 THEN ['medium_risk'] ELSE []::VARCHAR[] END,
           CASE WHEN amt < 700 THEN ['low_risk'] ELSE []::VARCHAR[] END]) AS outcomes
FROM ({EVENTS_SQL}) e""")
def q_rules_all(spark, sf):
    return fr.apply_rules(events(spark, sf).select("trans_num", "amt"), fr.AMOUNT_RULES, mode="ALL_MATCHED")


def _with_flow(df):
    return df.withColumn("flow_definition",
                         F.when(F.col("category") == "AUTOMOBILE", F.lit("ignore")).otherwise(F.lit("fraud-review")))


@register("frd7_review_queue", f"""
SELECT trans_num, {S}, flow_definition FROM (SELECT *, {FLOW_SQL} AS flow_definition FROM ({SCORED_SQL}) s) t
WHERE {S} BETWEEN 700 AND 900 AND flow_definition <> 'ignore'""")
def q_review_queue(spark, sf):
    return fr.review_queue(_with_flow(scored(spark, sf))).select("trans_num", S, "flow_definition")


@register("frd8_review_task", f"""
SELECT trans_num, CAST(to_json(struct_pack(score := struct_pack({S} := {S}),
   taskObject := struct_pack(variables := struct_pack(trans_num := trans_num, amt := CAST(amt AS VARCHAR),
      zip := CAST(zip AS VARCHAR), city := city, "first" := "first", job := job, street := street,
      category := category, city_pop := CAST(city_pop AS VARCHAR), gender := gender, cc_num := CAST(cc_num AS VARCHAR),
      "last" := "last", state := state, merchant := merchant),
   EVENT_TIMESTAMP := strftime(EVENT_TIMESTAMP, '%Y-%m-%dT%H:%M:%SZ')))) AS VARCHAR) AS task
FROM ({SCORED_SQL}) s WHERE {S} BETWEEN 700 AND 900""")
def q_review_task(spark, sf):
    s = fr.review_queue(scored(spark, sf), flow_col=None)
    s = s.withColumn("EVENT_TIMESTAMP", F.date_format("EVENT_TIMESTAMP", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return fr.review_task(s).select("trans_num", "task")


_VERDICT_SQL = ("CASE substr(md5('v:' || trans_num), 1, 1) WHEN '0' THEN 'Fraudulent' WHEN '1' THEN 'Fraudulent' "
                "WHEN '2' THEN 'Needs further review' ELSE 'Valid' END")


def verdict_col():
    h = F.substring(F.md5(F.concat(F.lit("v:"), F.col("trans_num"))), 1, 1)
    return (F.when(h.isin("0", "1"), F.lit("Fraudulent")).when(h == "2", F.lit("Needs further review"))
            .otherwise(F.lit("Valid")))


def _verdicts(spark, sf):
    """Completed review documents for the queued events whose review hash says 'answered'
    (written as JSON by Spark, read back by FRD9)."""
    from ..sources.readers import scratch_path

    q = fr.review_queue(scored(spark, sf), flow_col=None)
    answered = q.filter(F.substring(F.md5(F.concat(F.lit("a:"), F.col("trans_num"))), 1, 1) < "c")
    docs = answered.select(
        F.concat(F.lit("loop-"), F.col("trans_num")).alias("humanLoopName"),
        F.array(F.struct(F.struct(F.struct(verdict_col().alias("label")).alias("category")).alias("answerContent"),
                         F.lit("2020-09-01T00:00:00Z").alias("submissionTime"),
                         F.lit("w1").alias("workerId"))).alias("humanAnswers"),
        F.struct(F.struct(F.col(S).alias(S)).alias("score"),
                 F.struct(F.create_map(F.lit("trans_num"), F.col("trans_num")).alias("variables"),
                          F.col("EVENT_TIMESTAMP").cast("string").alias("EVENT_TIMESTAMP")).alias("taskObject")
                 ).alias("inputContent"))
    path = scratch_path(spark, "verdicts")
    docs.write.json(path)
    return fr.ingest_verdicts(spark, path, multiline=False)


_ANSWERED_SQL = f"""
SELECT trans_num, {S}, {_VERDICT_SQL} AS verdict FROM ({SCORED_SQL}) s
WHERE {S} BETWEEN 700 AND 900 AND substr(md5('a:' || trans_num), 1, 1) < 'c'"""


@register("frd9_ingest_verdicts", f"""
SELECT 'loop-' || trans_num AS humanLoopName, trans_num, verdict, {S} FROM ({_ANSWERED_SQL}) a""")
def q_ingest_verdicts(spark, sf):
    return _verdicts(spark, sf)


@register("joi6_attach_review", f"""
SELECT q.trans_num, q.{S}, a.verdict FROM ({SCORED_SQL}) q LEFT JOIN ({_ANSWERED_SQL}) a USING (trans_num)
WHERE q.{S} BETWEEN 700 AND 900""")
def q_attach_review(spark, sf):
    q = fr.review_queue(scored(spark, sf), flow_col=None).select("trans_num", S)
    answered, _pending = attach_review(q, _verdicts(spark, sf).select("trans_num", "verdict"), "trans_num")
    return answered


@register("joi6_pending_review", f"""
SELECT q.trans_num, q.{S} FROM ({SCORED_SQL}) q WHERE q.{S} BETWEEN 700 AND 900
AND q.trans_num NOT IN (SELECT trans_num FROM ({_ANSWERED_SQL}) a)""")
def q_pending_review(spark, sf):
    q = fr.review_queue(scored(spark, sf), flow_col=None).select("trans_num", S)
    _answered, pending = attach_review(q, _verdicts(spark, sf).select("trans_num", "verdict"), "trans_num")
    return pending


@register("frd10_score_distribution", f"""
SELECT EVENT_LABEL, CAST(least(floor({S} / 100.0), 9) AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n
FROM ({SCORED_SQL}) s GROUP BY ALL""")
def q_score_distribution(spark, sf):
    return fr.score_distribution(scored(spark, sf), S, "EVENT_LABEL", bins=10)


_CONF_SQL = f"""
WITH t(threshold) AS (VALUES {", ".join(f"(CAST({float(t)} AS DOUBLE))" for t in THRESHOLDS)}),
s AS ({SCORED_SQL}),
c AS (SELECT t.threshold,
        CAST(count(*) FILTER (WHERE {S} >= t.threshold AND EVENT_LABEL = 'fraud') AS BIGINT) AS TP,
        CAST(count(*) FILTER (WHERE {S} >= t.threshold AND NOT (EVENT_LABEL = 'fraud')) AS BIGINT) AS FP,
        CAST(count(*) FILTER (WHERE EVENT_LABEL = 'fraud') AS BIGINT) AS P,
        CAST(count(*) AS BIGINT) AS N_all
      FROM t, s GROUP BY t.threshold)
SELECT threshold, TP, FP, N_all - P - FP AS TN, P - TP AS FN,
       CASE WHEN P = 0 THEN NULL ELSE TP / P END AS TPR,
       CASE WHEN N_all - P = 0 THEN NULL ELSE FP / (N_all - P) END AS FPR,
       CASE WHEN TP + FP = 0 THEN NULL ELSE TP / (TP + FP) END AS "precision",
       (TP + FP) * 100000 / N_all AS alerts_per_100k
FROM c"""


@register("frd11_confusion_at", _CONF_SQL)
def q_confusion(spark, sf):
    return fr.confusion_at(scored(spark, sf), S, "EVENT_LABEL", THRESHOLDS)


@register("frd12_roc_curve", f"""
WITH c AS (SELECT {S} AS score, count(*) FILTER (WHERE EVENT_LABEL = 'fraud') AS pos,
                  count(*) FILTER (WHERE NOT (EVENT_LABEL = 'fraud')) AS neg FROM ({SCORED_SQL}) s GROUP BY 1)
SELECT score AS threshold,
       sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(pos) OVER () AS TPR,
       sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(neg) OVER () AS FPR
FROM c""")
def q_roc(spark, sf):
    return fr.roc_curve(scored(spark, sf), S, "EVENT_LABEL")


@register("frd12_auc", f"""
WITH c AS (SELECT {S} AS score, count(*) FILTER (WHERE EVENT_LABEL = 'fraud') AS pos,
                  count(*) FILTER (WHERE NOT (EVENT_LABEL = 'fraud')) AS neg FROM ({SCORED_SQL}) s GROUP BY 1),
x AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                  AS neg_below FROM c)
SELECT sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM x""")
def q_auc(spark, sf):
    return fr.auc(scored(spark, sf), S, "EVENT_LABEL")


@register("prj9_conform_variables", f"""
SELECT trans_num, coalesce(CAST(job AS VARCHAR), 'null') AS job, coalesce(TRY_CAST(city_pop AS DOUBLE), 0.0) AS city_pop,
       coalesce(TRY_CAST(amt AS DOUBLE), 0.0) AS amt, coalesce(street, 'null') AS street,
       coalesce(TRY_CAST(cc_num AS DOUBLE), 0.0) AS cc_num, coalesce(gender, 'null') AS gender,
       coalesce(merchant, 'null') AS merchant, coalesce("last", 'null') AS "last", coalesce("first", 'null') AS "first",
       coalesce(state, 'null') AS state, coalesce(city, 'null') AS city, coalesce(CAST(zip AS VARCHAR), 'null') AS zip,
       coalesce(category, 'null') AS category
FROM ({MAPPED_SQL}) m""")
def q_conform(spark, sf):
    return conform_variables(mapped(spark, sf), fr.CARD_VARIABLES, keep_others=False)


# ---- ML (rows-only checks) ---------------------------------------------------------------------

def _model(spark, sf, algorithm="logistic", train=None):
    train = train if train is not None else prepared(spark, sf)["train"]
    return fr.train_fraud_model(train, algorithm=algorithm, max_iter=10, buckets=64)


@register("frd3_train_and_score")
def q_train_score(spark, sf):
    """FRD3 + FRD6: fit on the train split, score and route the later events."""
    p = prepared(spark, sf)
    model = _model(spark, sf, train=p["train"])
    test = events(spark, sf).filter(F.col("EVENT_TIMESTAMP") > F.lit(TEST_MIN).cast("timestamp"))
    return fr.batch_predict(model, test).select("trans_num", "EVENT_LABEL", S, "rule_id", "outcomes")


@register("frd13_variable_importance")
def q_importance(spark, sf):
    """The labelled events of the training period, with each variable permuted."""
    return fr.variable_importance(_model(spark, sf), prepared(spark, sf)["train"])


@register("frd14_compare_versions")
def q_compare_versions(spark, sf):
    """Two model versions (the last years, and all, before the cutoff) scored on the same later events."""
    ev = events(spark, sf)
    test = ev.filter(F.col("EVENT_TIMESTAMP") > F.lit(TEST_MIN).cast("timestamp"))
    out = {}
    before = ev.filter(F.col("EVENT_TIMESTAMP") < F.lit(TRAIN_MAX).cast("timestamp"))
    for version, tr in (("v1", before.filter(F.col("EVENT_TIMESTAMP") >= F.lit("1998-01-01").cast("timestamp"))), ("v2", before)):
        m = fr.train_fraud_model(tr, max_iter=10, buckets=64)
        out[version] = fr.auc(fr.batch_predict(m, test), S, "EVENT_LABEL")
    return fr.compare_versions(out)
