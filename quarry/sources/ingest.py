"""Ingest: project raw datasets into the corpus row shape {text, source, doc_id?}.

The network download of the original tool is not rebuilt; readers start from
files (Parquet/JSONL) already on shared storage.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORPUS_COLUMNS = ["text", "source", "doc_id"]


def first_truthy(*cols: Column) -> Column:
    """``a or b or c`` over strings: first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in cols])


def ingest_dataset(df: DataFrame, name: str, text_field: str = "text") -> DataFrame:
    """Dataset source: ``text_field`` -> text, empty text skipped, source = registry name."""
    return (
        df.select(F.col(text_field).cast("string").alias("text"))
        .where(F.coalesce(F.col("text"), F.lit("")) != "")
        .select("text", F.lit(name).alias("source"), F.lit(None).cast("string").alias("doc_id"))
    )


def ingest_shards(df: DataFrame, prefix: str, shard: Column, text: Column, meta_url: Column | None = None,
                  meta_id: Column | None = None, meta_title: Column | None = None) -> DataFrame:
    """Sharded source: one shard per value of ``shard``; source = '<prefix>/<shard>';
    doc_id = first truthy of meta url, id, title; empty text skipped."""
    metas = [c for c in (meta_url, meta_id, meta_title) if c is not None]
    doc_id = first_truthy(*metas) if metas else F.lit(None).cast("string")
    return (
        df.select(text.cast("string").alias("text"), F.concat_ws("/", F.lit(prefix), shard).alias("source"),
                  doc_id.alias("doc_id"), shard.alias("shard"))
        .where(F.coalesce(F.col("text"), F.lit("")) != "")
    )


def shard_counts(ingested: DataFrame) -> DataFrame:
    """Rows written per shard (the per-shard kept counter)."""
    return ingested.groupBy("source").agg(F.count(F.lit(1)).alias("n_kept"))


@dataclass(frozen=True)
class SourceSpec:
    name: str
    kind: str  # "dataset" | "shards" | "instruction"
    reader: object = field(compare=False)  # callable () -> DataFrame already in corpus shape


KINDS = ("dataset", "shards", "instruction")


def ingest_union(specs: list[SourceSpec]) -> tuple[DataFrame | None, DataFrame | None]:
    """Run every registered source; returns (corpus, instructions).

    Instruction sources are routed to their own output so they never enter the
    corpus. An unknown kind raises.
    """
    corpus, instr = None, None
    for spec in specs:
        if spec.kind not in KINDS:
            raise ValueError(f"unknown source kind {spec.kind!r} for {spec.name}")
        df = spec.reader()
        if spec.kind == "instruction":
            instr = df if instr is None else instr.unionByName(df)
        else:
            df = df.select(*CORPUS_COLUMNS)
            corpus = df if corpus is None else corpus.unionByName(df)
    return corpus, instr


def select_shards(df: DataFrame, requested: list[str] | None = None, source_col: str = "source") -> DataFrame:
    """Rows of the requested shards (all when None)."""
    return df if requested is None else df.where(F.col(source_col).isin(list(requested)))


def list_shards(df: DataFrame, source_col: str = "source") -> DataFrame:
    return df.select(source_col).distinct().orderBy(source_col)


def missing_shards(spark, df: DataFrame, requested: list[str], source_col: str = "source") -> DataFrame:
    """Requested shard names that do not exist (left anti join against the distinct names)."""
    req = spark.createDataFrame([(r,) for r in requested], [source_col])
    return req.join(df.select(source_col).distinct(), on=source_col, how="left_anti")


def shard_stats(df: DataFrame, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Documents and characters per shard."""
    return df.groupBy(source_col).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.length(F.col(text_col))).alias("n_chars"))


def scan_ingested(spark, path: str, requested: list[str] | None = None) -> DataFrame:
    """Rows {text, source, doc_id} that ``sinks.write_corpus_rows`` wrote to a folder for each shard.

    Requested shards are selected by folder, so the others' files are not listed for reading (``PartitionFilters``). A name
    that has no folder raises ``ValueError`` with those that exist.
    """
    rows = spark.read.schema("text string, source string, doc_id string, shard string").json(path)
    if requested is None:
        return rows
    present = {r.shard for r in rows.where(F.col("shard").isin(list(requested))).select("shard").distinct().collect()}  # those asked for
    missing = sorted(set(requested) - present)
    if missing:
        names = [r.shard for r in rows.select("shard").distinct().orderBy("shard").limit(1000).collect()]
        raise ValueError(f"unknown shards {missing}; available: {names}")
    return rows.where(F.col("shard").isin(list(requested)))
