"""Custom labels on feature vectors (IMG1-IMG4): nearest-centroid classifier, ranked labels
with a confidence threshold, evaluation and error listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Numbers (labels x dimensions) of a block of the model, which lies beside every vector.
MODEL_NUMBERS = 4_000_000


def train_labels(vectors: DataFrame, vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """IMG1. Centroid per label: per-dimension mean, aggregated map-side by (label, dim).
    Returns ``(label, centroid array<double>)`` with one row per label."""
    e = vectors.select(label_col, F.posexplode(vec_col).alias("dim", "v"))
    m = e.groupBy(label_col, "dim").agg(F.avg(F.col("v").cast("double")).alias("v"))
    return m.groupBy(label_col).agg(F.array_sort(F.collect_list(F.struct("dim", "v"))).alias("__c")) \
        .select(label_col, F.transform("__c", lambda s: s["v"]).alias("centroid"))


def label_blocks(model: DataFrame, label_col: str = "label", block_labels: int | None = None) -> list[DataFrame]:
    """The model's centroids in blocks of ``block_labels`` (by default what ``MODEL_NUMBERS`` holds),
    each as one row with an array of (Name, c): as many frames as the model has blocks."""
    from .ranking import dense_index

    n, dims = model.agg(F.count(F.lit(1)), F.max(F.size("centroid"))).first()          # two scalars
    size = block_labels or max(1, MODEL_NUMBERS // max(dims or 1, 1))
    named = model.select(F.col(label_col).alias("Name"), F.col("centroid").alias("c"))
    if n > size:
        named = cut_lineage(named.join(dense_index(named, "Name", "__i"), "Name"))
    parts = [named.where(F.expr(f"__i div {size}") == b) if n > size else named for b in range(max(1, -(-n // size)))]
    return [p.agg(F.array_sort(F.collect_list(F.struct("Name", "c"))).alias("__m")) for p in parts]


def detect_labels(model: DataFrame, vectors: DataFrame, min_confidence: float = 60.0, id_col: str = "vec_id",
                  vec_col: str = "embedding", label_col: str = "label", temperature: float = 0.01,
                  block_labels: int | None = None) -> DataFrame:
    """IMG2. Ranked labels per vector: confidence = 100 x softmax(-distance / temperature)
    over the labels; labels under ``min_confidence`` are not reported (a vector may get none).

    The model is dealt in blocks of centroids (:func:`label_blocks`), each one row laid beside
    every vector, so scoring is a per-row map. A block gives a vector its least distance, its sum
    of exponentials relative to that, and the labels that reach the confidence within the block
    (they need no less within the whole model); the blocks of a vector are then merged by these."""
    rows = vectors.select(F.monotonically_increasing_id().alias("__row"), id_col, label_col, F.col(vec_col).alias("__v"))
    parts = None
    for block in label_blocks(model, label_col, block_labels):
        dists = F.transform("__m", lambda r: F.struct(r["Name"].alias("Name"), F.sqrt(F.aggregate(
            F.zip_with("__v", r["c"], lambda a, b: (a.cast("double") - b) * (a.cast("double") - b)), F.lit(0.0), lambda acc, v: acc + v)).alias("d")))
        x = rows.withColumn("__m", block.scalar()).select("__row", id_col, label_col, dists.alias("__d"))
        x = x.withColumn("__near", F.array_min(F.transform("__d", lambda s: s["d"])))
        e = F.transform("__d", lambda s: F.exp(-(s["d"] - F.col("__near")) / temperature))
        x = x.withColumn("__sum", F.aggregate(e, F.lit(0.0), lambda a, v: a + v))
        likely = F.filter("__d", lambda s: F.exp(-(s["d"] - F.col("__near")) / temperature) * 100.0 / F.col("__sum") >= min_confidence)
        x = x.select("__row", id_col, label_col, "__near", "__sum", likely.alias("__likely"))
        parts = x if parts is None else parts.unionByName(x)
        single = parts is x
    if single:
        merged = parts.withColumnsRenamed({"__near": "__least", "__sum": "__total"})
    else:
        g = parts.groupBy("__row").agg(F.first(id_col).alias(id_col), F.first(label_col).alias(label_col), F.min("__near").alias("__least"),
                                       F.collect_list(F.struct("__near", "__sum", "__likely")).alias("__blocks"))      # one for each block
        total = F.aggregate("__blocks", F.lit(0.0), lambda acc, b: acc + b["__sum"] * F.exp(-(b["__near"] - F.col("__least")) / temperature))
        merged = g.select(id_col, label_col, "__least", total.alias("__total"), F.flatten(F.transform("__blocks", lambda b: b["__likely"])).alias("__likely"))
    conf = F.transform("__likely", lambda s: F.struct(s["Name"].alias("Name"), (F.exp(-(s["d"] - F.col("__least")) / temperature) * 100.0 / F.col("__total")).alias("Confidence")))
    kept = F.filter(conf, lambda s: s["Confidence"] >= min_confidence)
    # most confident first; equal ones by name, the smaller first
    ranked = F.array_sort(F.transform(kept, lambda s: F.struct((-s["Confidence"]).alias("n"), s["Name"].alias("Name"), s["Confidence"].alias("Confidence"))))
    labels = F.transform(ranked, lambda s: F.struct(s["Name"].alias("Name"), s["Confidence"].alias("Confidence")))
    return merged.select(id_col, label_col, labels.alias("CustomLabels"))


def top_label(detections: DataFrame, label_col: str = "label") -> DataFrame:
    """Best label (or null when none passed the threshold) as ``predicted``."""
    return detections.withColumn("predicted", F.get(F.col("CustomLabels"), 0)["Name"]) \
        .withColumn("confidence", F.get(F.col("CustomLabels"), 0)["Confidence"])


def evaluate_labels(pred: DataFrame, label_col: str = "label", pred_col: str = "predicted") -> DataFrame:
    """IMG3. Per label: support, predicted, true positives, precision, recall, F1 — one pass:
    every row contributes to its true label and to its predicted label."""
    contrib = F.array(
        F.struct(F.col(label_col).alias("Name"), F.lit(1).alias("s"), (F.col(pred_col) == F.col(label_col))
                 .cast("int").alias("t"), F.lit(0).alias("p")),
        F.struct(F.col(pred_col).alias("Name"), F.lit(0).alias("s"), F.lit(0).alias("t"), F.lit(1).alias("p")))
    e = pred.select(F.inline(contrib)).filter(F.col("Name").isNotNull())
    j = e.groupBy("Name").agg(F.sum("s").cast("bigint").alias("support"), F.sum("p").cast("bigint").alias("predicted"),
                              F.coalesce(F.sum("t"), F.lit(0)).cast("bigint").alias("tp"))
    prec = F.try_divide(F.col("tp"), F.col("predicted"))
    rec = F.try_divide(F.col("tp"), F.col("support"))
    return j.select("Name", "support", "predicted", "tp", prec.alias("precision"), rec.alias("recall"),
                    F.try_divide(2 * prec * rec, prec + rec).alias("f1"))


def error_listing(pred: DataFrame, id_col: str = "vec_id", label_col: str = "label", pred_col: str = "predicted",
                  n: int | None = None) -> DataFrame:
    """IMG4. Wrong or missing predictions, listed per true label as false negatives and per
    predicted label as false positives, most confident first. The full listing is ranked
    with the skew-safe ``rank_within_group``; with ``n`` a top-n window is used."""
    from .ranking import rank_within_group

    wrong = pred.filter(F.col(pred_col).isNull() | (F.col(pred_col) != F.col(label_col)))
    fn = wrong.select(F.col(label_col).alias("Name"), F.lit("false_negative").alias("kind"), id_col, "confidence")
    fp = wrong.filter(F.col(pred_col).isNotNull()).select(F.col(pred_col).alias("Name"), F.lit("false_positive").alias("kind"),
                                                         id_col, "confidence")
    u = fn.unionByName(fp).withColumn("__grp", F.concat_ws(":", F.col("Name").cast("string"), F.col("kind")))
    if n:
        w = Window.partitionBy("Name", "kind").orderBy(F.col("confidence").desc_nulls_last(), F.col(id_col))
        return u.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).drop("__grp")
    u = u.withColumn("__negconf", F.coalesce(-F.col("confidence"), F.lit(float("inf"))))
    r = rank_within_group(u, "__grp", ["__negconf", id_col])
    return r.withColumn("rank", F.col("__rank").cast("int")).drop("__grp", "__negconf", "__rank", "__size")
