"""Sharding by bytes: global prefix sums cut at equal targets.

Documents are put in the order (doc_id, text_crc32, size) over range
partitions; each partition's byte total gives its offset, a running sum inside
the partition gives each document's place in the whole, and the place of its
middle byte among ``shards`` equal targets gives its shard. Shards are so
contiguous in that order, and their sizes differ from the target by less than
one document at either end.

Size: UTF-8 bytes of the text (none for null) plus 16. Null ids come first.
Rows that are equal in id and text are interchangeable, so ties change nothing;
they may fall on both sides of a cut. An empty table gives no rows. Extra input
columns are ignored. ``law`` is ``bytes``; ``grown_shard`` is null (a cut by
bytes moves when shards are added).

Only (id, size, crc32) rows are shuffled, never texts. One row per partition
goes through a single task for the offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.registry import query, table
from quarry.session import stage

SHARDS = 40
OVERHEAD = 16


def assign(docs: DataFrame, shards: int = SHARDS, text_col: str = "text", key_col: str = "doc_id") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``."""
    text = F.col(text_col)
    narrow = stage(docs.select(
        F.col(key_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_tie")), "shard-sizes")  # the tie splits a run of equal rows
    ranged = stage(narrow.repartitionByRange("doc_id", "text_crc32", "size", "_tie").sortWithinPartitions(
        "doc_id", "text_crc32", "size", "_tie").select(
        "doc_id", "size", "text_crc32", F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().alias("_seq")), "shard-ranges")

    totals = ranged.groupBy("_part").agg(F.sum("size").alias("_b"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = totals.select(
        "_part", F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_b0"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"))
    total = ranged.select(F.sum("size")).scalar()

    inside = Window.partitionBy("_part").orderBy("_seq")
    placed = ranged.select(
        "*", F.sum("size").over(inside).alias("_run"), F.row_number().over(inside).alias("_row")
    ).join(F.broadcast(offsets), "_part").select(  # one row per partition: bounded by the task count
        "doc_id", "size", "text_crc32", (F.col("_n0") + F.col("_row") - 1).alias("_at"),
        # twice the middle byte's place, exact in integers
        (2 * (F.col("_b0") + F.col("_run")) - F.col("size")).alias("_mid2"))
    share = F.floor(F.col("_mid2").cast("decimal(38,0)") * shards / (2 * total.cast("decimal(20,0)")))
    sharded = placed.select("doc_id", "size", "text_crc32", "_at",
                            F.least(share, F.lit(shards - 1)).cast("int").alias("shard"))
    first = sharded.groupBy("shard").agg(F.min("_at").alias("_first"))  # ``shards`` rows
    return sharded.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_at") - F.col("_first")).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@query("op6_sharding")
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents"))
