"""Registered label queries (IMG*, and the sampling/filter operators used on vectors)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import labels as lb
from ..operators.aggregates import detection_summary
from ..operators.filters import label_in, min_confidence
from ..operators.mapping import boxes_to_pixels
from ..operators.sampling import fraction_threshold, holdout_split, random_pick, take_per_class
from ..sources.readers import read_labeled_files, scratch_path
from .registry import register
from .views import vectors

HOLD = 0.2
MINCONF, TEMP = 60.0, 0.01
T = fraction_threshold(HOLD)


def split(spark, sf):
    return holdout_split(vectors(spark, sf), HOLD, "vec_id")


def model(spark, sf):
    return lb.train_labels(split(spark, sf)[0])


def detections(spark, sf):
    return lb.detect_labels(model(spark, sf), split(spark, sf)[1], MINCONF, temperature=TEMP)


def predictions(spark, sf):
    return lb.top_label(detections(spark, sf))


TRAIN_SQL = f"SELECT * FROM embeddings WHERE substr(md5('0:' || CAST(vec_id AS VARCHAR)), 1, 8) >= '{T}'"
TEST_SQL = f"SELECT * FROM embeddings WHERE substr(md5('0:' || CAST(vec_id AS VARCHAR)), 1, 8) < '{T}'"
CENTROID_SQL = f"""
SELECT label, list(v ORDER BY dim) AS centroid FROM (
  SELECT label, u.dim, avg(CAST(u.v AS DOUBLE)) AS v FROM ({TRAIN_SQL}) tr, unnest(embedding) WITH ORDINALITY AS u(v, dim)
  GROUP BY ALL) m GROUP BY label"""
DETECT_SQL = f"""
WITH c AS ({CENTROID_SQL}), t AS ({TEST_SQL}),
d AS (SELECT t.vec_id, t.label, c.label AS Name,
             sqrt(sum(pow(CAST(u.v AS DOUBLE) - c.centroid[u.dim], 2))) AS d
      FROM t, unnest(t.embedding) WITH ORDINALITY AS u(v, dim), c GROUP BY ALL),
e AS (SELECT *, exp(-(d - min(d) OVER (PARTITION BY vec_id)) / {TEMP}) AS ex FROM d),
f AS (SELECT *, ex * 100.0 / sum(ex) OVER (PARTITION BY vec_id) AS conf FROM e)
SELECT vec_id, label, coalesce(list(struct_pack(Name := Name, Confidence := conf) ORDER BY conf DESC, Name)
                                FILTER (WHERE conf >= {MINCONF}), []) AS CustomLabels
FROM f GROUP BY vec_id, label"""
PRED_SQL = f"SELECT *, CustomLabels[1].Name AS predicted, CustomLabels[1].Confidence AS confidence FROM ({DETECT_SQL}) x"


@register("img1_train_labels", CENTROID_SQL)
def q_train(spark, sf):
    return model(spark, sf)


@register("img2_detect_labels", f"""
SELECT vec_id, label, list_transform(CustomLabels, lambda x: struct_pack(Name := x.Name, Confidence := round(x.Confidence, 6)))
         AS CustomLabels
FROM ({DETECT_SQL}) d""")
def q_detect(spark, sf):
    d = detections(spark, sf)
    return d.withColumn("CustomLabels", F.transform("CustomLabels", lambda x: F.struct(
        x["Name"].alias("Name"), F.round(x["Confidence"], 6).alias("Confidence"))))


@register("img3_evaluate_labels", f"""
WITH p AS ({PRED_SQL}),
t AS (SELECT label AS Name, count(*) AS support, count(*) FILTER (WHERE predicted = label) AS tp FROM p GROUP BY 1),
q AS (SELECT predicted AS Name, count(*) AS predicted FROM p WHERE predicted IS NOT NULL GROUP BY 1),
j AS (SELECT coalesce(t.Name, q.Name) AS Name, CAST(coalesce(support, 0) AS BIGINT) AS support,
             CAST(coalesce(predicted, 0) AS BIGINT) AS predicted, CAST(coalesce(tp, 0) AS BIGINT) AS tp
      FROM t FULL JOIN q ON t.Name = q.Name),
m AS (SELECT *, CASE WHEN predicted = 0 THEN NULL ELSE tp / predicted END AS "precision",
             CASE WHEN support = 0 THEN NULL ELSE tp / support END AS recall FROM j)
SELECT *, CASE WHEN "precision" + recall = 0 THEN NULL ELSE 2 * "precision" * recall / ("precision" + recall) END AS f1 FROM m""")
def q_evaluate(spark, sf):
    return lb.evaluate_labels(predictions(spark, sf))


@register("agg4_detection_summary", f"""
SELECT CAST(count(*) FILTER (WHERE predicted = label) AS BIGINT) AS correct,
       CAST(count(*) FILTER (WHERE predicted IS NULL) AS BIGINT) AS below_threshold, CAST(count(*) AS BIGINT) AS total
FROM ({PRED_SQL}) p""")
def q_summary(spark, sf):
    return detection_summary(predictions(spark, sf))


@register("img4_error_listing", f"""
WITH p AS ({PRED_SQL}), w AS (SELECT * FROM p WHERE predicted IS NULL OR predicted <> label),
u AS (SELECT label AS Name, 'false_negative' AS kind, vec_id, confidence FROM w
      UNION ALL SELECT predicted AS Name, 'false_positive' AS kind, vec_id, confidence FROM w WHERE predicted IS NOT NULL)
SELECT *, CAST(row_number() OVER (PARTITION BY Name, kind ORDER BY confidence DESC NULLS LAST, vec_id) AS INTEGER) AS rank FROM u""")
def q_errors(spark, sf):
    return lb.error_listing(predictions(spark, sf))


@register("flt7_min_confidence",
          f"SELECT vec_id, label, predicted, confidence FROM ({PRED_SQL}) p WHERE confidence >= {MINCONF}")
def q_min_conf(spark, sf):
    return min_confidence(predictions(spark, sf), "confidence", MINCONF).select("vec_id", "label", "predicted",
                                                                                "confidence")


@register("flt7_min_confidence_null_label",
          f"SELECT vec_id, label, CASE WHEN confidence >= {MINCONF} THEN predicted END AS predicted, confidence FROM ({PRED_SQL}) p")
def q_min_conf_null(spark, sf):
    """FLT7, keeping every row: a label under the threshold becomes null."""
    p = predictions(spark, sf).select("vec_id", "label", "predicted", "confidence")
    return min_confidence(p, "confidence", MINCONF, label_col="predicted")


@register("flt3_label_in", "SELECT vec_id, label FROM embeddings WHERE label IN (1, 3, 5)")
def q_label_in(spark, sf):
    return label_in(vectors(spark, sf).select("vec_id", "label"), "label", [1, 3, 5])


@register("smp4_take_per_class", """
SELECT vec_id, label FROM (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM embeddings) x
WHERE rn <= 25""")
def q_take(spark, sf):
    return take_per_class(vectors(spark, sf).select("vec_id", "label"), "label", 25, "vec_id")


@register("smp5_random_pick", """
WITH cls AS (SELECT DISTINCT label FROM embeddings),
d AS (SELECT draw, arg_min(label, md5('3:c:' || CAST(draw AS VARCHAR) || ':' || CAST(label AS VARCHAR))) AS label
      FROM cls, range(0, 10) r(draw) GROUP BY draw)
SELECT CAST(d.draw AS INTEGER) AS draw, d.label, arg_min(e.vec_id, md5('3:f:' || CAST(d.draw AS VARCHAR) || ':' || CAST(e.vec_id AS VARCHAR))) AS vec_id
FROM d JOIN embeddings e ON e.label = d.label GROUP BY d.draw, d.label""")
def q_pick(spark, sf):
    return random_pick(vectors(spark, sf).select("vec_id", "label"), "label", "vec_id", 10, seed=3)


@register("smp6_holdout_split", f"SELECT vec_id, label FROM ({TEST_SQL}) t")
def q_holdout(spark, sf):
    return split(spark, sf)[1].select("vec_id", "label")


def _boxed(spark, sf):
    """Detections given a box derived from the vector (sigmoid of four components)."""
    sig = lambda i: 0.5 / (1.0 + F.exp(-F.get(F.col("embedding"), i).cast("double")))
    d = detections(spark, sf).join(split(spark, sf)[1].select("vec_id", "embedding"), "vec_id")
    box = F.struct(F.struct(sig(1).alias("Left"), sig(2).alias("Top"), sig(3).alias("Width"), sig(4).alias("Height"))
                   .alias("BoundingBox"))
    labels = F.transform("CustomLabels", lambda s: F.struct(s["Name"].alias("Name"), s["Confidence"].alias("Confidence"),
                                                          box.alias("Geometry")))
    return d.select("vec_id", labels.alias("CustomLabels"), F.lit(640).alias("width"), F.lit(480).alias("height"))


@register("prj12_boxes_to_pixels", f"""
WITH d AS ({DETECT_SQL}), t AS ({TEST_SQL}),
b AS (SELECT d.vec_id, u.lab, u.pos - 1 AS label_pos, 0.5 / (1.0 + exp(-CAST(t.embedding[2] AS DOUBLE))) AS l,
             0.5 / (1.0 + exp(-CAST(t.embedding[3] AS DOUBLE))) AS tp, 0.5 / (1.0 + exp(-CAST(t.embedding[4] AS DOUBLE))) AS w,
             0.5 / (1.0 + exp(-CAST(t.embedding[5] AS DOUBLE))) AS h
      FROM d JOIN t USING (vec_id), unnest(d.CustomLabels) WITH ORDINALITY AS u(lab, pos))
SELECT vec_id, 640 AS width, 480 AS height, CAST(label_pos AS INTEGER) AS label_pos, lab.Name AS label_name, lab.Confidence AS confidence,
       l * 640 AS left_px, tp * 480 AS top_px, l * 640 + w * 640 AS right_px, tp * 480 + h * 480 AS bottom_px
FROM b
UNION ALL
SELECT vec_id, 640, 480, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM d WHERE len(CustomLabels) = 0""")
def q_boxes(spark, sf):
    return boxes_to_pixels(_boxed(spark, sf))


@register("src9_read_labeled_files", "SELECT CAST(label AS VARCHAR) AS label, vec_id FROM embeddings WHERE label IN (1, 2, 3)")
def q_labeled_files(spark, sf):
    """Vectors written as files under a folder for each label; the files of three labels, line by line."""
    path = scratch_path(spark, "labeled")
    vectors(spark, sf).write.partitionBy("label").json(path)
    lines = F.explode(F.split(F.col("content").cast("string"), "\n"))
    return read_labeled_files(spark, path, labels=[1, 2, 3]).select("label", lines.alias("line")).where("line <> ''") \
        .select("label", F.get_json_object("line", "$.vec_id").cast("bigint").alias("vec_id"))
