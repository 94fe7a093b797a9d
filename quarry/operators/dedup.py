"""Exact deduplication on the normalized-text fingerprint.

Survivor rule: the row with the smallest order key among the rows that passed
every earlier check (so a dropped row never shadows a later one).

Plan shape (skew-safe, text never shuffled by hash):
  1. ``groupBy(doc_hash).agg(min(key))`` on a 2-column projection: partial
     aggregation collapses a hot hash (one text repeated a billion times) to one
     row per map task before the shuffle.
  2. winners are joined back on the *unique* order key, so no join key is hot.
     AQE broadcasts the winner keys when they are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import stage_keys


def winner_keys(candidates: DataFrame, hash_col: str = "doc_hash", key_col: str = "doc_id") -> DataFrame:
    """One row per distinct hash: the smallest order key holding it."""
    return candidates.groupBy(hash_col).agg(F.min(key_col).alias(key_col)).select(key_col)


def mark_duplicates(df: DataFrame, passed: Column, hash_col: str = "doc_hash", key_col: str = "doc_id",
                    out: str = "is_dup") -> DataFrame:
    """Add ``out``: true for rows that passed earlier checks but lost the hash race."""
    wins = winner_keys(df.where(passed).select(hash_col, key_col), hash_col, key_col).withColumn("_win", F.lit(True))
    return (
        df.join(wins, on=key_col, how="left")
        .withColumn(out, passed & F.col("_win").isNull())
        .drop("_win")
    )


def first_rows(df: DataFrame, hash_col: str = "doc_hash", key_col: str = "doc_id") -> DataFrame:
    """The rows of a staged ``df`` that ``mark_duplicates`` does not mark, as often as it returns them; none of them is moved.

    Most keys win once. The others (losers, and keys that repeat and win with several texts) are broadcast, see ``stage_keys``.
    """
    keys = df.select(hash_col, key_col)
    wins = winner_keys(keys, hash_col, key_col).groupBy(key_col).agg(F.count(F.lit(1)).alias("_wins"))
    held = keys.select(key_col).where(F.col(key_col).isNotNull()).distinct().join(wins, key_col, "left")
    odd = stage_keys(held.select(key_col, F.coalesce("_wins", F.lit(0)).cast("int").alias("_wins")).where("_wins <> 1"), "odd-keys")
    rows = df.where(F.col(key_col).isNotNull())
    once = rows.join(odd.select(key_col), key_col, "left_anti")
    if odd.where("_wins > 1").isEmpty():
        return once
    more = rows.join(odd.where("_wins > 1"), key_col).withColumn("_wins", F.explode(F.array_repeat(F.lit(0), F.col("_wins")))).drop("_wins")
    return once.unionByName(more)


def dedup_exact(df: DataFrame, hash_col: str = "doc_hash", key_col: str = "doc_id") -> DataFrame:
    """Keep the first row (smallest order key) of every distinct hash."""
    wins = winner_keys(df.select(hash_col, key_col), hash_col, key_col)
    return df.join(wins, on=key_col, how="left_semi")
