import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from flowlab.session import DEFAULT_CONF, ensure_checkpoint_dir

    b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8") \
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None) and s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="flowlab-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fixtures():
    return FIXTURES
