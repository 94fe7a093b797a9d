"""Incremental corpus preparation with Structured Streaming.

Raw shards keep arriving (ingest writes one file per shard); this job picks up
new ``*.jsonl`` files with the file-stream source and runs the preparation
stages on each micro-batch:

  readStream.text(raw) -> parse (malformed skipped) -> normalize / length /
  language checks -> exact dedup within the batch (smallest order key) and
  against every fingerprint kept by earlier batches -> append kept rows and
  their fingerprints -> append the batch's counters.

The fingerprint table plays the part of the reference's in-memory seen-set,
but lives in files on shared storage and is joined, not collected. Each batch
writes into its own ``batch_id=<n>`` folders with overwrite, so a retried batch
replaces its partial output (the streaming checkpoint records which batches
committed). Use ``trigger(availableNow=True)`` for scheduled runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.plans import prepare as P
from quarry.plans.options import PrepareOptions
from quarry.session import path_exists
from quarry.sources import jsonl

RAW_SCHEMA = T.StructType([T.StructField("text", T.StringType()), T.StructField("source", T.StringType())])


def _process_batch(batch: DataFrame, batch_id: int, output: str, opts: PrepareOptions, lang_model) -> None:
    spark = batch.sparkSession
    lines = batch.select("value", "file_path", F.struct(
        F.split("file_path", "/").alias("path"), F.lit(batch_id).cast("long").alias("block"),
        F.monotonically_increasing_id().alias("line")).alias("order_key"))
    recs = jsonl.parse(lines, RAW_SCHEMA).where(~F.col("_malformed"))
    rows = recs.select("order_key", "text", jsonl.default_if_missing("source", "unknown"))
    cls = P.classify(rows, opts, key_col="order_key", lang_model=lang_model)  # staged once per batch

    hashes_dir = f"{output}/hashes"
    if path_exists(spark, hashes_dir):  # else no earlier batch has written yet; any other failure fails the batch
        earlier = spark.read.parquet(hashes_dir).where(F.col("batch_id") < batch_id).select("doc_hash")
        seen = earlier.withColumn("_seen", F.lit(True))
        cls = cls.join(seen, on="doc_hash", how="left").withColumn(
            "reason", F.when((F.col("reason") == "kept") & F.col("_seen"), F.lit("dup")).otherwise(F.col("reason"))
        ).drop("_seen")
    cls = P.stage(cls, f"stream-batch-{batch_id}")

    kept = cls.where(F.col("reason") == "kept")
    kept.select(F.col("norm_text").alias("text"), "source").write.mode("overwrite").json(
        f"{output}/rows/batch_id={batch_id}")
    kept.select("doc_hash").write.mode("overwrite").parquet(f"{hashes_dir}/batch_id={batch_id}")
    P.stats(cls).write.mode("overwrite").parquet(f"{output}/stats/batch_id={batch_id}")


def start(spark: SparkSession, raw_dir: str, output: str, checkpoint: str, opts: PrepareOptions = PrepareOptions(),
          lang_model=None, available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the incremental job; returns the StreamingQuery."""
    reader = spark.readStream.format("text").option("pathGlobFilter", "*.jsonl")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(raw_dir).select("value", F.col("_metadata.file_path").alias("file_path"))
    writer = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, bid: _process_batch(df, bid, output, opts, lang_model))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def totals(spark: SparkSession, output: str) -> DataFrame:
    """Counters summed over all committed batches."""
    st = spark.read.parquet(f"{output}/stats")
    return st.agg(*[F.sum(c).alias(c) for c in P.STATS_COLUMNS])
