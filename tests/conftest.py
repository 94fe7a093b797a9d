import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="quarry-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
    yield s


@pytest.fixture
def one_col(spark):
    """Evaluate a Column function over a list of strings, returning Python values in order."""
    from pyspark.sql import functions as F, types as T

    def run(fn, values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
        return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]
    return run
