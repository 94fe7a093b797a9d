"""Corpus pipeline: the documents table through the training-data operators, stage by stage.

Each stage takes (spark, docs, sf_dir), where docs is what its predecessor kept,
and returns a DataFrame. ``run`` writes each result as Parquet under the shared
checkpoint folder and reads it back for the next stage, so a lost executor
costs at most the stage that is running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import op2_near, op3_mix, op6_shards, op8_decon, op10_lang
from quarry.session import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; the rest goes."""
    return op10_lang.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each near-duplicate group (Jaccard 0.8 of 5-word shingles)."""
    return op2_near.keep_first(docs, 80, 100)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item (0.8 of its 5-word shingles)."""
    return op8_decon.keep_clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with raked source, language and topic weights."""
    return op3_mix.keep_sampled(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document."""
    return op6_shards.assign(docs)


STAGES = [
    ("language ID", identify_language),
    ("near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: Not expressible in SQL: language ID and near-dedup are trained or randomized operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
