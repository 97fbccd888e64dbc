"""Fraud workflow (FRD1-FRD14): prepare, score, route by ordered rules, review, evaluate."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .filters import score_band, time_cutoff_split
from .mapping import (VariableSpec, apply_mapping, copy_column, drop_fields, event_envelope,
                      recode_label)
from .ranking import cumulative_within_group
from .sampling import stratified_exact_sample

# ---- fixed values (must equal the reference's) -------------------------------------------
# Raw card-transaction CSV -> typed columns: (source, source type, target, target type).
CARD_TRANSACTION_MAPPINGS = [
    ("trans_date_trans_time", "string", "trans_date_trans_time", "timestamp"),
    ("cc_num", "long", "cc_num", "long"),
    ("merchant", "string", "merchant", "string"),
    ("category", "string", "category", "string"),
    ("amt", "double", "amt", "double"),
    ("first", "string", "first", "string"),
    ("last", "string", "last", "string"),
    ("gender", "string", "gender", "string"),
    ("street", "string", "street", "string"),
    ("city", "string", "city", "string"),
    ("state", "string", "state", "string"),
    ("zip", "long", "zip", "long"),
    ("lat", "double", "lat", "double"),
    ("long", "double", "long", "double"),
    ("city_pop", "long", "city_pop", "int"),
    ("job", "string", "job", "string"),
    ("dob", "string", "dob", "date"),
    ("trans_num", "string", "trans_num", "string"),
    ("unix_time", "long", "unix_time", "int"),
    ("merch_lat", "double", "merch_lat", "double"),
    ("merch_long", "double", "merch_long", "double"),
    ("is_fraud", "long", "is_fraud", "short"),
]
# Columns dropped right after the mapping.
DROPPED_AFTER_MAPPING = ["col0", "merch_lat", "merch_long", "lat", "long", "unix_time", "dob"]
# Label codes.
LABELS = {0: "legit", 1: "fraud"}
# Declared event variables: (name, data type, default, kind).
CARD_VARIABLES = [
    VariableSpec("trans_num", "STRING", "null", "ORDER_ID"),
    VariableSpec("job", "STRING", "null", "CATEGORICAL"),
    VariableSpec("city_pop", "FLOAT", "0.0", "NUMERIC"),
    VariableSpec("amt", "FLOAT", "0.0", "PRICE"),
    VariableSpec("street", "STRING", "null", "BILLING_ADDRESS_L1"),
    VariableSpec("cc_num", "FLOAT", "0.0", "NUMERIC"),
    VariableSpec("gender", "STRING", "null", "CATEGORICAL"),
    VariableSpec("merchant", "STRING", "null", "CATEGORICAL"),
    VariableSpec("last", "STRING", "null", "BILLING_NAME"),
    VariableSpec("first", "STRING", "null", "BILLING_NAME"),
    VariableSpec("state", "STRING", "null", "BILLING_STATE"),
    VariableSpec("city", "STRING", "null", "BILLING_CITY"),
    VariableSpec("zip", "STRING", "null", "BILLING_ZIP"),
    VariableSpec("category", "STRING", "null", "PRODUCT_CATEGORY"),
]
# Review band on the insight score (closed, Q6) and the score range.
REVIEW_MIN, REVIEW_MAX = 700, 900
SCORE_MAX = 1000
# Review verdict categories.
VERDICTS = ["Fraudulent", "Valid", "Needs further review"]
# -------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """An ordered rule: ``$name`` refers to a column; the rest is a SQL boolean expression."""

    rule_id: str
    expression: str
    outcomes: list = field(default_factory=list)


# ---- fixed values: rule sets --------------------------------------------------------------
# Gap-free rules on the model insight score (Q5).
SCORE_RULES = [
    Rule("high_fraud_risk", "$fraud_model_insightscore > 900", ["verify_customer"]),
    Rule("medium_fraud_risk", "$fraud_model_insightscore <= 900 and $fraud_model_insightscore > 700", ["review"]),
    Rule("low_fraud_risk", "$fraud_model_insightscore <= 700", ["approve"]),
]
# Placeholder rules on the amount (they leave exactly 900 and 700 unmatched).
AMOUNT_RULES = [
    Rule("investigate", "$amt > 900", ["high_risk"]),
    Rule("review", "$amt < 900 and $amt > 700", ["medium_risk"]),
    Rule("approve", "$amt < 700", ["low_risk"]),
]
# -------------------------------------------------------------------------------------------

_VAR = re.compile(r"\$([A-Za-z_][A-Za-z0-9_]*)")


def rule_condition(expression: str):
    """``$amt > 900`` -> Column ```amt` > 900``."""
    return F.expr(_VAR.sub(lambda m: f"`{m.group(1)}`", expression))


def apply_rules(df: DataFrame, rules, mode: str = "FIRST_MATCHED") -> DataFrame:
    """FRD5. Ordered rules evaluated as one CASE expression (FIRST_MATCHED) or as the array
    of all matching rule ids (ALL_MATCHED). No match -> null rule, empty outcomes."""
    conds = [rule_condition(r.expression) for r in rules]
    if mode == "FIRST_MATCHED":
        rid = out = None
        for r, c in zip(rules, conds):
            o = F.array(*[F.lit(x) for x in r.outcomes]).cast("array<string>")
            rid = F.when(c, F.lit(r.rule_id)) if rid is None else rid.when(c, F.lit(r.rule_id))
            out = F.when(c, o) if out is None else out.when(c, o)
        return df.withColumn("rule_id", rid).withColumn(
            "outcomes", F.coalesce(out, F.array().cast("array<string>")))
    if mode == "ALL_MATCHED":
        ids = F.array(*[F.when(c, F.lit(r.rule_id)) for r, c in zip(rules, conds)])
        outs = F.array(*[F.when(c, F.array(*[F.lit(x) for x in r.outcomes]))
                         .otherwise(F.array().cast("array<string>")) for r, c in zip(rules, conds)])
        return df.withColumn("rule_ids", F.filter(ids, lambda x: x.isNotNull())).withColumn(
            "outcomes", F.flatten(outs))
    raise ValueError(f"unknown rule mode {mode}")


def order_event_columns(df: DataFrame, trailing=("EVENT_TIMESTAMP", "EVENT_LABEL")) -> DataFrame:
    """SNK5. Variables first, then the trailing metadata columns in the given order."""
    tail = [c for c in trailing if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in tail], *tail)


def model_variables(df: DataFrame) -> list[str]:
    """FRD2. All columns but the last two (timestamp and label), read from the schema only."""
    return df.columns[:-2]


def prepare_fraud(raw: DataFrame, train_max, test_min, fraud_samples: int = 12, legit_samples: int = 130,
                  entity_type: str = "customer", mappings=None, seed: int = 0, stable: bool = True) -> dict:
    """FRD1. Raw transactions -> ``train`` (variables, EVENT_TIMESTAMP, EVENT_LABEL) and
    ``test_sample`` (variables, EVENT_TIMESTAMP, ENTITY_TYPE, ENTITY_ID, EVENT_ID; no label)."""
    m = apply_mapping(raw, mappings or CARD_TRANSACTION_MAPPINGS)
    m = drop_fields(m, DROPPED_AFTER_MAPPING)
    m = copy_column(m, "trans_date_trans_time", "EVENT_TIMESTAMP")
    m = copy_column(m, "is_fraud", "EVENT_LABEL")
    train, test = time_cutoff_split(m, "EVENT_TIMESTAMP", train_max, test_min)
    train = recode_label(train, "EVENT_LABEL", LABELS)
    test = event_envelope(recode_label(test, "EVENT_LABEL", LABELS), entity_type)
    train = drop_fields(train, ["is_fraud", "trans_date_trans_time"])
    test = drop_fields(test, ["is_fraud", "trans_date_trans_time"])
    sample = stratified_exact_sample(test, "EVENT_LABEL", {"fraud": fraud_samples, "legit": legit_samples},
                                     seed=seed, id_col="EVENT_ID", stable=stable)
    sample = drop_fields(sample, ["EVENT_LABEL"])
    return {
        "train": order_event_columns(train),
        "test_sample": order_event_columns(sample, ("EVENT_TIMESTAMP", "ENTITY_TYPE", "ENTITY_ID", "EVENT_ID")),
    }


def insight_score(df: DataFrame, prob_col: str = "probability", out: str = "fraud_model_insightscore") -> DataFrame:
    """FRD4. Probability of fraud -> integer-valued score 0..1000. Accepts a double column or
    an ML probability vector (second element)."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import VectorUDT

    c = F.col(prob_col)
    if isinstance(df.schema[prob_col].dataType, VectorUDT):
        c = vector_to_array(c)[1]
    return df.withColumn(out, F.round(c * SCORE_MAX, 0))


def review_queue(scored: DataFrame, score_col: str = "fraud_model_insightscore", lo: float = REVIEW_MIN,
                 hi: float = REVIEW_MAX, flow_col: str | None = "flow_definition") -> DataFrame:
    """FRD7. Rows in the closed band, unless the event's flow is 'ignore'."""
    out = score_band(scored, score_col, lo, hi)
    if flow_col and flow_col in scored.columns:
        out = out.filter(F.coalesce(F.col(flow_col), F.lit("ignore")) != "ignore")
    return out


# Fields shown to a reviewer, in display order.
REVIEW_FIELDS = ["trans_num", "amt", "zip", "city", "first", "job", "street", "category", "city_pop",
                 "gender", "cc_num", "last", "state", "merchant"]


def review_task(df: DataFrame, score_col: str = "fraud_model_insightscore", fields=None,
                ts_col: str = "EVENT_TIMESTAMP", out: str = "task") -> DataFrame:
    """FRD8. ``{"score": {...}, "taskObject": {"variables": {...}, "EVENT_TIMESTAMP": ...}}`` JSON text."""
    fields = [f for f in (fields or REVIEW_FIELDS) if f in df.columns]
    body = F.struct(
        F.struct(F.col(score_col).alias("fraud_model_insightscore")).alias("score"),
        F.struct(F.struct(*[F.col(f).cast("string").alias(f) for f in fields]).alias("variables"),
                 F.col(ts_col).cast("string").alias("EVENT_TIMESTAMP")).alias("taskObject"))
    return df.withColumn(out, F.to_json(body, {"ignoreNullFields": "false"}))


VERDICT_SCHEMA = ("humanLoopName string, "
                  "humanAnswers array<struct<answerContent: struct<category: struct<label: string>>, "
                  "submissionTime: string, workerId: string>>, "
                  "inputContent struct<score: struct<fraud_model_insightscore: double>, "
                  "taskObject: struct<variables: map<string,string>, EVENT_TIMESTAMP: string>>")


def ingest_verdicts(spark, path: str, multiline: bool = True) -> DataFrame:
    """FRD9. Completed review files (one JSON document each, or JSON lines) -> verdict table."""
    raw = spark.read.schema(VERDICT_SCHEMA).option("multiLine", multiline).json(path)
    return raw.select(
        F.col("humanLoopName"),
        F.col("inputContent.taskObject.variables")["trans_num"].alias("trans_num"),
        F.get("humanAnswers", F.lit(0))["answerContent"]["category"]["label"].alias("verdict"),
        F.col("inputContent.score.fraud_model_insightscore").alias("fraud_model_insightscore"),
    )


def score_distribution(df: DataFrame, score_col: str, label_col: str, bins: int = 10,
                       lo: float = 0.0, hi: float = SCORE_MAX) -> DataFrame:
    """FRD10. Histogram per class: bin = least(floor((s - lo) / width), bins - 1)."""
    width = (hi - lo) / bins
    b = F.least(F.floor((F.col(score_col) - lo) / width), F.lit(bins - 1)).cast("int")
    return df.groupBy(F.col(label_col).alias(label_col), b.alias("bin")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


def confusion_at(df: DataFrame, score_col: str, label_col: str, thresholds, positive="fraud",
                 scale_to: int = 100_000) -> DataFrame:
    """FRD11. Confusion counts and rates at each threshold (predict fraud when score >= t).

    One aggregation pass with conditional sums per threshold (no join of rows with
    thresholds), then the tiny result is turned into one row per threshold.
    """
    pos = F.col(label_col) == F.lit(positive)
    aggs = [F.count_if(pos).cast("bigint").alias("P"), F.count(F.lit(1)).cast("bigint").alias("N_all")]
    for i, t in enumerate(thresholds):
        hit = F.col(score_col) >= F.lit(t)
        aggs += [F.count_if(hit & pos).cast("bigint").alias(f"tp{i}"),
                 F.count_if(hit & ~pos).cast("bigint").alias(f"fp{i}")]
    a = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("TP"),
                              F.col(f"fp{i}").alias("FP")) for i, t in enumerate(thresholds)])
    r = a.select("P", "N_all", F.inline(rows))
    neg = F.col("N_all") - F.col("P")
    return r.select(
        "threshold", "TP", "FP",
        (neg - F.col("FP")).alias("TN"), (F.col("P") - F.col("TP")).alias("FN"),
        F.try_divide(F.col("TP"), F.col("P")).alias("TPR"),
        F.try_divide(F.col("FP"), neg).alias("FPR"),
        F.try_divide(F.col("TP"), F.col("TP") + F.col("FP")).alias("precision"),
        F.try_divide((F.col("TP") + F.col("FP")) * F.lit(scale_to), F.col("N_all")).alias("alerts_per_100k"),
    )


def score_counts(df: DataFrame, score_col: str, label_col: str, positive="fraud") -> DataFrame:
    """Positives and negatives per distinct score (partial aggregation; the result has at most
    one row per distinct score, <= 1001 for insight scores)."""
    pos = F.col(label_col) == F.lit(positive)
    return df.groupBy(F.col(score_col).alias("score")).agg(
        F.count_if(pos).cast("bigint").alias("pos"), F.count_if(~pos).cast("bigint").alias("neg"))


def roc_curve(df: DataFrame, score_col: str, label_col: str, positive="fraud") -> DataFrame:
    """FRD12. (threshold, TPR, FPR) at every distinct score, from the per-score counts."""
    c = score_counts(df, score_col, label_col, positive).withColumn("__down", -F.col("score"))
    c = cumulative_within_group(c, [], ["__down"], "pos", cum_col="__tp", total_col="__p")
    c = cumulative_within_group(c, [], ["__down"], "neg", cum_col="__fp", total_col="__n")
    return c.select(F.col("score").alias("threshold"), (F.col("__tp") / F.col("__p")).alias("TPR"), (F.col("__fp") / F.col("__n")).alias("FPR"))


def auc(df: DataFrame, score_col: str, label_col: str, positive="fraud") -> DataFrame:
    """FRD12. Exact AUC = P(s+ > s-) + 0.5 P(s+ = s-), ties included, from per-score counts."""
    c = score_counts(df, score_col, label_col, positive)
    x = cumulative_within_group(c, [], ["score"], "neg", cum_col="__up_to", total_col="__all") \
        .withColumn("neg_below", F.col("__up_to") - F.col("neg"))
    return x.agg(
        (F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg")))
         / (F.sum("pos") * F.sum("neg"))).alias("auc"))


# ---- model training and scoring (Spark ML) --------------------------------------------------

_NUMERIC = {"FLOAT", "INTEGER"}


def feature_plan(spec, buckets: int = 1024):
    """Numeric variables enter as they are; each string variable is hashed into its own
    block of ``buckets`` slots (no driver-side dictionary, so cardinality is unbounded).
    Unique ids (ORDER_ID) are left out."""
    numeric = [v.name for v in spec if v.data_type in _NUMERIC]
    strings = [v.name for v in spec if v.data_type not in _NUMERIC and v.kind != "ORDER_ID"]
    return numeric, strings, buckets


def train_fraud_model(df: DataFrame, spec=None, label_col: str = "EVENT_LABEL", positive="fraud",
                      algorithm: str = "logistic", buckets: int = 1024, max_iter: int = 20, seed: int = 0):
    """FRD3. Supervised binary classifier over the declared variables, with balanced class
    weights. Returns a fitted ``PipelineModel``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, LogisticRegression
    from pyspark.ml.feature import FeatureHasher, VectorAssembler

    spec = spec or [v for v in CARD_VARIABLES if v.name in df.columns]
    numeric, strings, buckets = feature_plan(spec, buckets)
    data = prepare_training(df, spec, label_col, positive)
    stages = [FeatureHasher(inputCols=[s], outputCol=f"__h_{s}", numFeatures=buckets, categoricalCols=[s])
              for s in strings]
    stages.append(VectorAssembler(inputCols=numeric + [f"__h_{s}" for s in strings], outputCol="features",
                                  handleInvalid="keep"))
    if algorithm == "gbt":
        clf = GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", maxIter=max_iter, seed=seed)
    else:
        clf = LogisticRegression(labelCol="label", featuresCol="features", weightCol="weight", maxIter=max_iter,
                                 regParam=0.01, standardization=True)
    stages.append(clf)
    return Pipeline(stages=stages).fit(data)


def prepare_training(df: DataFrame, spec, label_col: str, positive) -> DataFrame:
    """Label as 0/1 and a balanced weight per row (weights from two global counts)."""
    from .mapping import conform_variables

    d = conform_variables(df, spec).withColumn("label", (F.col(label_col) == F.lit(positive)).cast("double"))
    d = cut_lineage(d.filter(F.col(label_col).isNotNull()))      # counted for the weights, then read by every pass of the fit
    from pyspark.sql import Window
    # class weight = n / (2 * n_class), from a grouped count (<= 2 rows) joined back
    cnt = d.groupBy("label").agg(F.count(F.lit(1)).alias("__n"))
    wts = cnt.select("label", (F.sum("__n").over(Window.partitionBy()) / (2.0 * F.col("__n"))).alias("weight"))
    return d.join(F.broadcast(wts), "label")   # <= 2 rows


def batch_predict(model, events: DataFrame, spec=None, rules=None) -> DataFrame:
    """FRD6. Score events with a fitted model, map to the 0-1000 insight score and route by
    the ordered rules."""
    spec = spec or [v for v in CARD_VARIABLES if v.name in events.columns]
    from .mapping import conform_variables

    scored = model.transform(conform_variables(events, spec))
    scored = insight_score(scored, "probability")
    keep = [c for c in events.columns] + ["fraud_model_insightscore"]
    return apply_rules(scored.select(*keep), rules or SCORE_RULES)


def _with_moved_values(rows: DataFrame, variables, id_col: str, seed: int) -> DataFrame:
    """Every row once, with ``__p0``, ``__p1``, ... beside it: the value of each variable that its
    variant has. Rows are ranked by the md5 of their id; variable k takes its values from ``shift_k``
    ranks further on, the last rows from the first: a stable permutation, the same for all of one
    variable's rows. Values travel to their rank, one shuffle for all variables."""
    import zlib

    ranked = rows.withColumn("__key", F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string"))))
    ranked = cumulative_within_group(ranked, [], ["__key", id_col], None, cum_col="__rank", total_col="__n").drop("__key")
    ranked = cut_lineage(ranked.withColumn("__at", F.col("__rank") - 1).drop("__rank"))
    n = ranked.agg(F.max("__n")).first()[0] or 0                  # one scalar
    shifts = [1 + zlib.crc32(f"{seed}:{v}".encode()) % max(n - 1, 1) for v in variables]
    sent = ranked.select(F.inline(F.array(*[F.struct(F.pmod(F.col("__at") - k, F.lit(max(n, 1))).alias("__to"), F.lit(i).alias("__i"), F.col(v).cast("string").alias("__v"))
                                            for i, (v, k) in enumerate(zip(variables, shifts))])))
    # dealt first: one row for each place and variable, nothing for a map-side sort to combine
    moved = sent.repartition("__to").groupBy("__to").agg(*[F.max(F.when(F.col("__i") == i, F.col("__v"))).alias(f"__p{i}") for i in range(len(variables))])
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    return ranked.join(moved, F.col("__at") == F.col("__to")) \
        .select(*rows.columns, *[F.col(f"__p{i}").cast(kinds[v]).alias(f"__p{i}") for i, v in enumerate(variables)])


def _variants(both: DataFrame, swaps: dict, n: int) -> DataFrame:
    """Variants 0 to ``n`` of every row; column c is ``swaps[c][1]`` in variant ``swaps[c][0]``, which
    keeps the column's metadata (ML stages read vector sizes from it)."""
    out = both.withColumn("__variant", F.explode(F.sequence(F.lit(0), F.lit(n))))
    names = [c for c in both.columns if c not in {p for _, p in swaps.values()}]

    def column(c):
        if c not in swaps:
            return F.col(c)
        k, p = swaps[c]
        return F.when(F.col("__variant") == k, F.col(p)).otherwise(F.col(c)).alias(c, metadata=both.schema[c].metadata)

    return out.select(*[column(c) for c in names], "__variant")


def permuted_variants(rows: DataFrame, variables, id_col: str, seed: int = 0) -> DataFrame:
    """Every row once as it is (``__variant`` 0) and once for each variable with that variable's
    value from another row (:func:`_with_moved_values`)."""
    variables = list(variables)
    both = _with_moved_values(rows, variables, id_col, seed)
    return _variants(both, {v: (i + 1, f"__p{i}") for i, v in enumerate(variables)}, len(variables))


def scored_variants(model, rows: DataFrame, variables, id_col: str, seed: int = 0) -> DataFrame:
    """``model.transform`` of :func:`permuted_variants`. What a stage makes of one variable alone (its
    hashed block) is the same in all variants but one, so such stages see each row twice, with its
    own and with its moved value, before the variants are made; only the others see every variant."""
    from pyspark.ml.feature import FeatureHasher

    variables = list(variables)
    df = _with_moved_values(rows, variables, id_col, seed)
    swaps, rest = {v: (i + 1, f"__p{i}") for i, v in enumerate(variables)}, []
    for stage in getattr(model, "stages", [model]):
        reads = stage.getInputCols() if isinstance(stage, FeatureHasher) else []
        if len(reads) != 1 or reads[0] not in variables:
            rest.append(stage)
            continue
        v, out = reads[0], stage.getOutputCol()
        moved, made = swaps[v][1], f"__m_{out}"
        df = stage.transform(df).withColumnsRenamed({v: "__own", moved: v, out: "__made"})      # the hash holds the column's name
        df = stage.transform(df).withColumnsRenamed({v: moved, "__own": v, out: made, "__made": out})
        swaps[out] = (swaps[v][0], made)
    df = _variants(df, swaps, len(variables))
    for stage in rest:
        df = stage.transform(df)
    return df


def auc_by(df: DataFrame, group: str, score_col: str, label_col: str, positive="fraud") -> DataFrame:
    """Exact AUC for each value of ``group``."""
    pos = F.col(label_col) == F.lit(positive)
    c = df.groupBy(F.col(group), F.col(score_col).alias("score")).agg(F.count_if(pos).alias("pos"), F.count_if(~pos).alias("neg"))
    x = cumulative_within_group(c, [group], ["score"], "neg", cum_col="__up_to", total_col="__all")
    below = F.col("__up_to") - F.col("neg")
    return x.groupBy(group).agg(F.try_divide(F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))), F.sum("pos") * F.sum("neg")).alias("auc"))


def variable_importance(model, events: DataFrame, spec=None, id_col: str = "trans_num", label_col: str = "EVENT_LABEL",
                        positive="fraud", seed: int = 0) -> DataFrame:
    """FRD13. (variable, auc, importance): how much of the AUC goes when a variable's values are
    dealt to other events (:func:`scored_variants`). It depends on what the model does with the
    variable, not on its unit; a variable that the model has no use for is near zero. All variants
    are scored in one pass; unlabelled events are left out, ids should tell events apart."""
    from .mapping import conform_variables

    spec = spec or [v for v in CARD_VARIABLES if v.name in events.columns]
    numeric, strings, _ = feature_plan(spec)
    names = numeric + strings
    rows = conform_variables(events, spec).where(F.col(label_col).isNotNull())
    keep = list(dict.fromkeys([id_col, label_col, *names]))
    scored = insight_score(scored_variants(model, rows.select(*keep), names, id_col, seed), "probability")
    by = auc_by(scored, "__variant", "fraud_model_insightscore", label_col, positive)
    base = by.where("__variant = 0").agg(F.max("auc").alias("__base"))
    name = F.element_at(F.array(*[F.lit(v) for v in names]), F.col("__variant"))
    return by.where("__variant > 0").select(name.alias("variable"), "auc", (base.scalar() - F.col("auc")).alias("importance"))


def compare_versions(metrics: dict[str, DataFrame]) -> DataFrame:
    """FRD14. Metric rows of several model versions side by side, keyed by version."""
    out = None
    for version, m in metrics.items():
        x = m.withColumn("model_version", F.lit(version))
        out = x if out is None else out.unionByName(x, allowMissingColumns=True)
    return out
