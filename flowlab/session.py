"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for correctness (UTC, ANSI) and for scale (AQE).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "flowlab", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with flowlab's defaults. Used by tests and bench;
    on a cluster, pass the cluster's own session to the operators instead."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is given by the cluster's configuration and is used as is.
    Only when it is unset (local tests) a folder on the default Hadoop filesystem is chosen, so
    that every executor reaches it; it is registered with ``SparkContext.setCheckpointDir``
    (the core setting itself cannot change at runtime).
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        home = sc._jvm.org.apache.hadoop.fs.FileSystem.get(sc._jsc.hadoopConfiguration()).getUri().toString()
        d = f"{home.rstrip('/')}/tmp/flowlab-ckpt-{uuid.uuid4().hex}"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared checkpoint folder) so that a lost
    executor does not force recomputation of a long lineage; never a local checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
