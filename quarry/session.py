"""Session helpers.

``get_spark`` is only a convenience for tests, bench and local runs; library
functions never create sessions, they use ``df.sparkSession``.

``staging_dir`` returns the shared folder named by ``spark.checkpoint.dir``. On a
cluster that setting points at shared storage (HDFS/S3/...); it is only filled in
here when unset (local runs and tests), never overridden.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

ID_ROWS = 2_000_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, app: str = "quarry", shuffle_partitions: int | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.files.maxPartitionBytes", str(32 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local session without one gets a temporary folder;
    on a cluster a machine-local folder would not be seen by other machines, so that raises."""
    jsc = spark.sparkContext._jsc.sc()
    held = jsc.getCheckpointDir()
    current = spark.conf.get("spark.checkpoint.dir", None) or (held.get() if held.isDefined() else None)
    if not current:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        current = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not held.isDefined():
        spark.sparkContext.setCheckpointDir(current)
    return current


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its own file system."""
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


_STAGED: list[str] = []


def staging_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir for written tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    _STAGED.append(f"{root}/quarry-staging/{name}-{uuid.uuid4().hex[:12]}")
    return _STAGED[-1]


def clear_staging(spark: SparkSession) -> None:
    """Delete every staged table of this driver. Frames that still read one become unusable."""
    while _STAGED:
        fs, p = _file_system(spark, _STAGED.pop())
        fs.delete(p, True)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """The shuffle files of a write inside are deleted as it ends: nothing reads them again, and they would stay on the
    executors' disks until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def stage(df, name: str, codec: str | None = None):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Used where a table feeds several branches (it is computed once), to cut
    lineage, and to freeze nondeterministic ids; files on shared storage
    survive executor loss.
    """
    path = staging_dir(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    with shuffles_removed(df.sparkSession):
        (writer.option("compression", codec) if codec else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def stage_keys(df, name: str):
    """Narrow rows, staged; up to ``ID_ROWS`` of them are broadcast to the rows they are joined with, which then stay where they are."""
    held = stage(df, name)
    return F.broadcast(held) if held.count() <= ID_ROWS else held
