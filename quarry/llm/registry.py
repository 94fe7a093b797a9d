"""Query registry of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of it in any case: for columns that an operator adds for a while."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name


def fold(key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4 (null for a null id)."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4
