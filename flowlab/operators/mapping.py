"""Projections (PRJ1-PRJ12): declarative rename/cast, drops, label recodes, envelopes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _q(name: str) -> str:
    """Backtick a column name unless it already is."""
    return name if name.startswith("`") else "`" + name.replace("`", "``") + "`"


def _has(df: DataFrame, name: str) -> bool:
    return name.strip("`") in df.columns


def apply_mapping(df: DataFrame, mappings, strict: bool = False) -> DataFrame:
    """PRJ1. ``mappings`` is a list of ``(src, src_type, dst, dst_type)``.

    Only mapped columns survive (Q9). Bad values become null (``try_cast``, Q7) unless
    ``strict`` is set, in which case they raise. A source column that is absent yields
    a typed null column, as a per-record schema would.
    """
    cols: list[Column] = []
    for src, _src_type, dst, dst_type in mappings:
        if _has(df, src):
            c = F.col(_q(src))
            c = c.cast(dst_type) if strict else c.try_cast(dst_type)
        else:
            c = F.lit(None).cast(dst_type)
        cols.append(c.alias(dst))
    return df.select(*cols)


def drop_fields(df: DataFrame, paths) -> DataFrame:
    """PRJ2. Drop top-level columns or nested ``a.b`` struct fields; missing ones are a no-op (Q8)."""
    top = [p for p in paths if "." not in p.strip("`")]
    out = df.drop(*[p.strip("`") for p in top])
    for p in paths:
        if "." in p.strip("`"):
            head, rest = p.split(".", 1)
            if head in out.columns and isinstance(out.schema[head].dataType, T.StructType):
                if rest in out.schema[head].dataType.fieldNames():
                    out = out.withColumn(head, F.col(_q(head)).dropFields(rest))
    return out


def rename_field(df: DataFrame, old: str, new: str) -> DataFrame:
    """PRJ3."""
    return df.withColumnRenamed(old, new)


def copy_column(df: DataFrame, src: str, dst: str) -> DataFrame:
    """PRJ4."""
    return df.withColumn(dst, F.col(_q(src)))


def add_constant(df: DataFrame, name: str, value, dtype: str | None = None) -> DataFrame:
    """PRJ5. A literal column; replaces a per-row Python map."""
    c = F.lit(value)
    return df.withColumn(name, c.cast(dtype) if dtype else c)


def recode_label(df: DataFrame, col: str, mapping: dict, out: str | None = None) -> DataFrame:
    """PRJ6. ``{0: 'legit', 1: 'fraud'}``; compared as integers (Q3), unmatched -> null."""
    src = F.col(_q(col)).try_cast("int")
    expr = None
    for k, v in mapping.items():
        expr = F.when(src == F.lit(int(k)), F.lit(v)) if expr is None else expr.when(src == F.lit(int(k)), F.lit(v))
    return df.withColumn(out or col, expr.cast("string"))


def event_envelope(df: DataFrame, entity_type: str, id_col: str = "trans_num") -> DataFrame:
    """PRJ7. ENTITY_TYPE (given), ENTITY_ID='unknown', EVENT_ID = the transaction id."""
    return (df.withColumn("ENTITY_TYPE", F.lit(entity_type))
              .withColumn("ENTITY_ID", F.lit("unknown"))
              .withColumn("EVENT_ID", F.col(_q(id_col))))


def split_fields(df: DataFrame, paths) -> dict[str, DataFrame]:
    """PRJ8. Two frames from one: the listed columns, and the rest."""
    keep = [p for p in paths if _has(df, p)]
    rest = [c for c in df.columns if c not in keep]
    return {"selected": df.select(*[_q(c) for c in keep]), "rest": df.select(*[_q(c) for c in rest])}


@dataclass(frozen=True)
class VariableSpec:
    """A declared model variable: name, data type (STRING | FLOAT | INTEGER | BOOLEAN),
    default used when the value is missing or does not parse, and its kind."""

    name: str
    data_type: str
    default: str
    kind: str

    @property
    def spark_type(self) -> str:
        return {"STRING": "string", "FLOAT": "double", "INTEGER": "bigint", "BOOLEAN": "boolean"}[self.data_type]


def conform_variables(df: DataFrame, spec, keep_others: bool = True) -> DataFrame:
    """PRJ9. Cast each declared variable to its type and fill its default."""
    out = df
    for v in spec:
        src = F.col(_q(v.name)) if _has(df, v.name) else F.lit(None)
        val = src.try_cast(v.spark_type) if v.spark_type != "string" else src.cast("string")
        out = out.withColumn(v.name, F.coalesce(val, F.lit(v.default).try_cast(v.spark_type)))
    if not keep_others:
        out = out.select(*[_q(v.name) for v in spec])
    return out


def payload_schema(spec) -> T.StructType:
    """Schema of a single-event payload: all variables arrive as strings."""
    return T.StructType([
        T.StructField("variables", T.StructType([T.StructField(v.name, T.StringType()) for v in spec])),
        T.StructField("EVENT_TIMESTAMP", T.StringType()),
        T.StructField("flow_definition", T.StringType()),
    ])


def parse_event_payload(df: DataFrame, json_col: str, spec) -> DataFrame:
    """PRJ10. JSON payload text -> typed variables, event timestamp, flow (missing -> 'ignore')."""
    p = F.from_json(F.col(_q(json_col)), payload_schema(spec))
    flat = df.select("*", p.alias("__p")).select(
        *[F.col(_q(c)) for c in df.columns],
        *[F.col(f"__p.variables.{_q(v.name)}").alias(v.name) for v in spec],
        F.to_timestamp(F.col("__p.EVENT_TIMESTAMP")).alias("EVENT_TIMESTAMP"),
        F.coalesce(F.col("__p.flow_definition"), F.lit("ignore")).alias("flow_definition"),
    )
    return conform_variables(flat, spec)


def derive_year(df: DataFrame, col: str, fmt: str = "yyyy-MM-dd", out: str = "year") -> DataFrame:
    """PRJ11. Year of a date given as text (or a date/timestamp column)."""
    dt = df.schema[col.strip("`")].dataType
    d = F.to_date(F.col(_q(col)), fmt) if isinstance(dt, T.StringType) else F.to_date(F.col(_q(col)))
    return df.withColumn(out, F.year(d))


def boxes_to_pixels(df: DataFrame, labels_col: str = "CustomLabels", width_col: str = "width",
                    height_col: str = "height") -> DataFrame:
    """PRJ12. One row per detected label with pixel box corners (relative box x image size)."""
    e = df.select("*", F.posexplode_outer(F.col(labels_col)).alias("label_pos", "__l")).drop(labels_col)
    box = F.col("__l.Geometry.BoundingBox")
    w, h = F.col(width_col), F.col(height_col)
    left = box["Left"] * w
    top = box["Top"] * h
    return e.select(
        *[c for c in e.columns if c != "__l"],
        F.col("__l.Name").alias("label_name"),
        F.col("__l.Confidence").alias("confidence"),
        left.alias("left_px"), top.alias("top_px"),
        (left + box["Width"] * w).alias("right_px"),
        (top + box["Height"] * h).alias("bottom_px"),
    )
