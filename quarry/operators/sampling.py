"""Split, shuffle, shard, hold out, mix and sample, all order-independent.

Randomness comes from SHA-1 of ``seed:key`` so results do not depend on
partitioning, arrival order or reruns.

Global ranks (``global_rank``) never sort all rows on one task: rows are cut into
buckets by the leading hex digits of their hash (the hash is uniform, so buckets
are balanced and a bucket order equals hash order), per-bucket counts (at most
16**digits rows per partition value: a proven size bound) are turned into
running offsets and broadcast, and ``row_number`` runs within each bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import stage

TWO_32 = 4294967296.0


def seeded_hash(seed: int, key: Column) -> Column:
    """Hex SHA-1 of 'seed:key'."""
    return F.sha1(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def hash_uniform(h: Column, start: int = 9) -> Column:
    """Uniform double in [0, 1) from 8 hex digits of ``h`` (1-based ``start``)."""
    return F.conv(F.substring(h, start, 8), 16, 10).cast("bigint") / F.lit(TWO_32)


def split_train_val(df: DataFrame, key: str = "doc_hash", seed: int = 42, val_ratio: float = 0.05,
                    out: str = "split") -> DataFrame:
    """Seeded Bernoulli split: u < val_ratio -> 'val' (strict, so ratio 0 gives no val)."""
    u = hash_uniform(seeded_hash(seed, F.col(key)), 9)
    return df.withColumn(out, F.when(u < F.lit(float(val_ratio)), F.lit("val")).otherwise(F.lit("train")))


def holdout_sources(df: DataFrame, sources: list[str], key: str = "doc_hash", seed: int = 42,
                    val_ratio: float = 0.05, source_col: str = "source", out: str = "split") -> DataFrame:
    """Whole sources go to 'val'; other rows get the seeded split."""
    split = split_train_val(df, key, seed, val_ratio, out="_split")
    return split.withColumn(
        out, F.when(F.col(source_col).isin(list(sources)), F.lit("val")).otherwise(F.col("_split"))
    ).drop("_split")


def global_rank(df: DataFrame, hash_col: str, tie_col: str, partition_cols: list[str] | None = None,
                digits: int = 4, out: str = "rank", value_col: str | None = None) -> DataFrame:
    """0-based rank of each row by (hash_col, tie_col) within ``partition_cols``.

    With ``value_col`` the result is instead the running sum of that column over
    the preceding rows (exclusive prefix sum), e.g. token offsets for packing.
    ``hash_col`` must be a uniform hex string (e.g. SHA-1).
    """
    parts = list(partition_cols or [])
    val = F.col(value_col) if value_col else F.lit(1)
    keyed = df.withColumn("__gr_bk", F.substring(F.col(hash_col), 1, digits)).withColumn("__gr_v", val.cast("bigint"))
    counts = keyed.groupBy(*parts, "__gr_bk").agg(F.sum("__gr_v").alias("__gr_n"))
    w = Window.partitionBy(*parts).orderBy("__gr_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__gr_off", F.coalesce(F.sum("__gr_n").over(w), F.lit(0))).drop("__gr_n")
    # offsets hold at most 16**digits rows per partition value: broadcast is size-bounded
    ranked = keyed.join(F.broadcast(offsets), on=[*parts, "__gr_bk"])
    wr = Window.partitionBy(*parts, "__gr_bk").orderBy(hash_col, tie_col)
    if value_col:
        inner = F.coalesce(F.sum("__gr_v").over(wr.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    else:
        inner = F.row_number().over(wr) - 1
    return ranked.withColumn(out, F.col("__gr_off") + inner).drop("__gr_bk", "__gr_off", "__gr_v")


def shuffle_rank(df: DataFrame, key: str, seed: int = 42, partition_cols: list[str] | None = None,
                 out: str = "rank") -> DataFrame:
    """Seeded shuffle order as a dense 0-based rank (ties broken by the key)."""
    h = df.withColumn("_h", seeded_hash(seed, F.col(key)))
    return global_rank(h, "_h", key, partition_cols, out=out).drop("_h")


def assign_shards(df: DataFrame, key: str, shard_size: int, seed: int = 42, split_col: str = "split",
                  out: str = "shard") -> DataFrame:
    """Fixed-size shards per split in shuffled order: every shard but the last holds shard_size rows."""
    ranked = shuffle_rank(df, key, seed, [split_col], out="_rank")
    return ranked.withColumn(out, (F.col("_rank") / F.lit(shard_size)).cast("bigint")).withColumnRenamed("_rank", "rank")


def order_rank(df: DataFrame, order_cols: list, partition_cols: list[str] | None = None, out: str = "rank") -> DataFrame:
    """(order_cols, partition_cols, rank): the 0-based place of each row in the order of ``order_cols`` within ``partition_cols``.

    For orders that are no uniform hash (path and line, length and key). Only the named columns move: they are sorted in
    range partitions, each partition's counts give its offsets (one row for each partition and partition value), and rows are
    numbered inside. ``order_cols`` is unique and without nulls; no task holds more than a range of the order.
    """
    parts = list(partition_cols or [])
    narrow = df.select(*order_cols, *[c for c in parts if c not in order_cols])
    ranged = stage(narrow.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols).select(
        "*", F.spark_partition_id().alias("__or_p"), F.monotonically_increasing_id().alias("__or_s")), "order-ranges")
    counts = ranged.groupBy(*parts, "__or_p").agg(F.count(F.lit(1)).alias("__or_n"))
    before = Window.partitionBy(*parts).orderBy("__or_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__or_o", F.coalesce(F.sum("__or_n").over(before), F.lit(0))).drop("__or_n")
    inside = Window.partitionBy(*parts, "__or_p").orderBy("__or_s")
    ranked = ranged.withColumn("__or_i", F.row_number().over(inside) - 1).join(offsets, [*parts, "__or_p"])
    return ranked.withColumn(out, F.col("__or_o") + F.col("__or_i")).drop("__or_p", "__or_s", "__or_o", "__or_i")


def assign_shards_in_order(df: DataFrame, order_cols: list[str], shard_size: int, split_col: str = "split", out: str = "shard") -> DataFrame:
    """``df`` with ``rank`` and ``shard``: fixed-size shards per split in input order, every one but the last full."""
    ranked = order_rank(df, order_cols, [split_col]).drop(split_col)
    return df.join(ranked, order_cols).withColumn(out, F.floor(F.col("rank") / F.lit(shard_size)).cast("bigint"))


def sample_fixed(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """The n rows with the smallest seeded hash (top-k; n is the feature's sample size)."""
    return df.withColumn("_h", seeded_hash(seed, F.col(key))).orderBy("_h", key).limit(n).drop("_h")


def mix_instructions(text: DataFrame, instructions: DataFrame, ratio: float, seed: int = 42,
                     id_col: str = "id") -> DataFrame:
    """Interleave instructions so that at most ``ratio`` of the rows are instructions.

    n = floor(ratio / (1 - ratio) * N_text) instructions are taken (the n smallest
    seeded hashes, none repeated); the union is ranked in seeded-hash order.
    Both inputs carry ``id_col`` (string) and ``kind``.
    """
    if ratio <= 0:
        mixed = text
    else:
        factor = float(ratio) / (1.0 - float(ratio))
        n_text = text.agg(F.count(F.lit(1))).scalar()  # scalar subquery, one value
        quota = F.floor(n_text * F.lit(factor))
        ranked = shuffle_rank(instructions, id_col, seed, out="_irank")
        taken = ranked.where(F.col("_irank") < quota).drop("_irank")
        mixed = text.unionByName(taken)
    return shuffle_rank(mixed, id_col, seed, out="mix_rank")
