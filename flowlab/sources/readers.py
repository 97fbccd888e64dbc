"""Scans and sources (SRC1-SRC11). Schemas are always explicit except in ``read_csv_inferred``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/flowlab-scratch/{name}-{uuid.uuid4().hex[:12]}"


def read_csv(spark: SparkSession, paths, schema, sep: str = ",", quote: str = '"', header: bool = True,
             recurse: bool = False) -> DataFrame:
    """SRC1. Header CSV with an explicit schema; quoted fields may hold separators and quotes."""
    r = (spark.read.schema(schema).option("header", header).option("sep", sep).option("quote", quote)
         .option("escape", quote).option("multiLine", False).option("mode", "PERMISSIVE"))
    if recurse:
        r = r.option("recursiveFileLookup", True)
    return r.csv(paths)


def read_table(spark: SparkSession, db: str | None, table: str) -> DataFrame:
    """SRC2. Catalog scan."""
    return spark.table(f"`{db}`.`{table}`" if db else f"`{table}`")


def _ddl(schema) -> str:
    if isinstance(schema, str):
        return schema
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def register_csv_table(spark: SparkSession, name: str, location: str, schema, header: bool = True,
                       sep: str = ",") -> DataFrame:
    """SRC3. All files under a folder form one table (e.g. train + test), with an explicit schema."""
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    spark.sql(f"""CREATE TABLE `{name}` ({_ddl(schema)}) USING csv
                  OPTIONS (header '{str(header).lower()}', sep '{sep}', recursiveFileLookup 'true')
                  LOCATION '{location}'""")
    return spark.table(f"`{name}`")


def read_csv_inferred(spark: SparkSession, paths, sep: str = ",") -> DataFrame:
    """SRC4. Profiling only: let Spark infer the types (one extra pass over the data)."""
    return spark.read.option("header", True).option("inferSchema", True).option("sep", sep).csv(paths)


def read_csv_matching(spark: SparkSession, folder: str, schema, suffix: str = ".csv",
                      name_regex: str | None = None, others: str = "raise") -> DataFrame:
    """SRC5. Files picked by suffix, whose names must match ``name_regex``: a row of any other file
    fails the read with the file's name (``others="skip"`` leaves such files out instead). Checked
    on the file name metadata as rows are read, so nothing is listed on the driver."""
    df = (spark.read.schema(schema).option("header", True).option("pathGlobFilter", f"*{suffix}")
          .option("recursiveFileLookup", True).csv(folder))
    if name_regex:
        name = F.col("_metadata.file_name")
        unexpected = F.raise_error(F.concat(F.lit(f"unexpected file name, not like {name_regex}: "), name)).cast("boolean")
        df = df.filter(F.when(name.rlike(name_regex), F.lit(True)).otherwise(unexpected if others == "raise" else F.lit(False)))
    return df


REQUEST_SCHEMA = T.StructType([T.StructField("userId", T.StringType()), T.StructField("itemId", T.StringType())])


def read_requests(spark: SparkSession, path) -> DataFrame:
    """SRC6. JSON lines ``{"userId": ...}`` or ``{"itemId": ...}``; blank lines are skipped."""
    df = spark.read.schema(REQUEST_SCHEMA).json(path)
    return df.filter(F.col("userId").isNotNull() | F.col("itemId").isNotNull())


RESULT_SCHEMA = T.StructType([
    T.StructField("input", T.StructType([T.StructField("userId", T.StringType()),
                                         T.StructField("itemId", T.StringType())])),
    T.StructField("output", T.StructType([
        T.StructField("recommendedItems", T.ArrayType(T.StringType())),
        T.StructField("usersList", T.ArrayType(T.StringType())),
        T.StructField("scores", T.ArrayType(T.DoubleType()))])),
    T.StructField("error", T.StringType()),
])


def read_recommendations(spark: SparkSession, path) -> DataFrame:
    """SRC7. Batch recommendation result lines ``{input, output, error}``."""
    return spark.read.schema(RESULT_SCHEMA).json(path)


def read_json_docs(spark: SparkSession, path, schema=None, multiline: bool = True) -> DataFrame:
    """SRC8. One JSON document per file (multi-line), or one per line, with a schema when known."""
    r = spark.read.option("multiLine", multiline)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_labeled_files(spark: SparkSession, root: str, labels=None, glob: str | None = None) -> DataFrame:
    """SRC9. Files under ``<root>/<label>/<name>``; the label is the parent folder name
    (``key=value`` folders give the value)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(root).select("path", "length", "content")
    parent = F.element_at(F.split(F.col("path"), "/"), -2)
    df = df.withColumn("label", F.regexp_replace(parent, r"^[^=]*=", ""))
    df = df.withColumn("file_name", F.element_at(F.split(F.col("path"), "/"), -1))
    if labels is not None:
        df = df.filter(F.col("label").isin([str(x) for x in labels]))
    return df


def create_external_table(spark: SparkSession, name: str, location: str, schema, sep: str = "\t",
                          header: bool = False) -> DataFrame:
    """SRC10. Drop-if-exists, create over delimited text, and return ``count(*)``."""
    register_csv_table(spark, name, location, schema, header=header, sep=sep)
    return spark.sql(f"SELECT count(*) AS n FROM `{name}`")


def latest_output(spark: SparkSession, folder: str, fmt: str = "csv", schema=None, whole_run: bool = False, **options) -> DataFrame:
    """SRC11. Rows of the newest file under a folder (by modification time, then path), or with
    ``whole_run`` of all files in that file's folder, as a run writes many. The newest path is an aggregate over the files' names and times (their content is not read);
    then that one path is read. An empty folder raises, as any missing input does."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", options.get("recursiveFileLookup", "true")) \
        .load(folder).select("path", "modificationTime").where(~F.col("path").rlike("/[._][^/]*$"))
    newest = files.agg(F.max(F.struct("modificationTime", "path"))["path"]).first()[0]
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(newest.rsplit("/", 1)[0] if whole_run and newest else newest)
