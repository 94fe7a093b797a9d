"""Registered queries: split, shuffle, shard, hold out, mix, sample (kept corpus rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import instructions as INS
from quarry.operators import sampling as SM
from quarry.plans import prepare as P
from quarry.plans import sql as S
from quarry.plans.registry import docs_with_edges, query, table
from quarry.session import staging_dir
from quarry.sources import jsonl, shard_files, sinks

SEED = 42
SHARD_SIZE = 100  # rows per shard in the checked queries (several shards per split)
HOLDOUT = ["src0", "src1"]
MIX_RATIO = 0.05
SAMPLE_N = 50


def kept(spark, sf_dir):
    return P.kept_rows(P.classify(docs_with_edges(spark, sf_dir)))


SPLIT = S.split_case("doc_hash", SEED, 0.05)
H = S.seeded_hash(SEED, "doc_hash")


@query("split_train_val", f"WITH {S.kept()} SELECT doc_id, {SPLIT} AS split FROM kept")
def q_split(spark, sf_dir):
    return SM.split_train_val(kept(spark, sf_dir), "doc_hash", SEED, 0.05).select("doc_id", "split")


@query("holdout_sources", f"WITH {S.kept()} SELECT doc_id, CASE WHEN source IN ('src0', 'src1') THEN 'val' "
       f"ELSE {SPLIT} END AS split FROM kept")
def q_holdout(spark, sf_dir):
    return SM.holdout_sources(kept(spark, sf_dir), HOLDOUT, "doc_hash", SEED, 0.05).select("doc_id", "split")


_RANKED = (f"WITH {S.kept()}, sp AS (SELECT doc_id, doc_hash, {SPLIT} AS split FROM kept), "
           f"rk AS (SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY {H}, doc_hash) - 1 AS rank FROM sp)")


@query("shuffle_rank", _RANKED + " SELECT doc_id, split, rank FROM rk")
def q_shuffle_rank(spark, sf_dir):
    df = SM.split_train_val(kept(spark, sf_dir), "doc_hash", SEED, 0.05)
    return SM.shuffle_rank(df, "doc_hash", SEED, ["split"]).select("doc_id", "split", "rank")


@query("assign_shards", _RANKED + f" SELECT doc_id, split, CAST(rank // {SHARD_SIZE} AS BIGINT) AS shard FROM rk")
def q_assign_shards(spark, sf_dir):
    df = SM.split_train_val(kept(spark, sf_dir), "doc_hash", SEED, 0.05)
    return SM.assign_shards(df, "doc_hash", SHARD_SIZE, SEED).select("doc_id", "split", "shard")


@query("write_shards", _RANKED + f" SELECT split, CAST(rank // {SHARD_SIZE} AS BIGINT) AS shard, count(*) AS n_rows "
       "FROM rk GROUP BY ALL")
def q_write_shards(spark, sf_dir):
    df = SM.split_train_val(kept(spark, sf_dir).withColumn("text", F.col("norm_text")), "doc_hash", SEED, 0.05)
    sharded = SM.assign_shards(df, "doc_hash", SHARD_SIZE, SEED)
    path = sinks.write_shards(sharded, staging_dir(spark, "shards"))
    back = sinks.read_shards(spark, path)
    return back.groupBy("split", F.col("shard").cast("bigint").alias("shard")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("sample_fixed", f"WITH {S.kept()} SELECT doc_id FROM kept ORDER BY {H}, doc_hash LIMIT {SAMPLE_N}")
def q_sample_fixed(spark, sf_dir):
    return SM.sample_fixed(kept(spark, sf_dir), "doc_hash", SAMPLE_N, SEED).select("doc_id")


_FACTOR = MIX_RATIO / (1.0 - MIX_RATIO)
_MIX_SQL = f"""WITH {S.kept()}, {S.pairs()},
t AS (SELECT 'doc:' || doc_id AS id, 'text' AS kind FROM kept),
i AS (SELECT 'inst:' || conv_id || ':' || turn AS id, 'instruction' AS kind FROM pairs),
ir AS (SELECT *, row_number() OVER (ORDER BY {S.seeded_hash(SEED, 'id')}, id) - 1 AS r FROM i),
m AS (SELECT * FROM t UNION ALL
      SELECT id, kind FROM ir WHERE r < floor((SELECT count(*) FROM t) * CAST({_FACTOR!r} AS DOUBLE)))
SELECT id, kind, row_number() OVER (ORDER BY {S.seeded_hash(SEED, 'id')}, id) - 1 AS mix_rank FROM m"""


@query("mix_instructions", _MIX_SQL)
def q_mix(spark, sf_dir):
    text = kept(spark, sf_dir).select(F.concat(F.lit("doc:"), F.col("doc_id")).alias("id"), F.lit("text").alias("kind"))
    pairs = INS.conversation_pairs(table(spark, sf_dir, "conversations"))
    inst = pairs.select(F.concat_ws(":", F.lit("inst"), "conv_id", "turn").alias("id"), F.lit("instruction").alias("kind"))
    return SM.mix_instructions(text, inst, MIX_RATIO, SEED).select("id", "kind", "mix_rank")


@query("write_shard_files", f"""WITH {S.kept()}, sp AS (SELECT norm_text, doc_hash, {SPLIT} AS split FROM kept),
rk AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY {H}, doc_hash) - 1 AS rank FROM sp)
SELECT split || '/part-' || lpad(CAST(rank // {SHARD_SIZE} AS VARCHAR), 4, '0') || '.jsonl' AS file, count(*) AS n_rows,
  sha1(string_agg(sha1(norm_text), ',' ORDER BY rank)) AS rows_sha1 FROM rk GROUP BY 1""")
def q_write_shard_files(spark, sf_dir):
    """Exact shard files written, listed and read again line by line."""
    df = SM.split_train_val(kept(spark, sf_dir).withColumn("text", F.col("norm_text")), "doc_hash", SEED, 0.05)
    path = shard_files.write_shard_files(SM.assign_shards(df, "doc_hash", SHARD_SIZE, SEED), staging_dir(spark, "shard-files"))
    names = shard_files.list_shard_files(spark, path)
    rows = jsonl.scan_jsonl_lenient(spark, [f"{path}/{n}" for n in names], jsonl.TEXT_RECORD)
    lines = rows.select(F.regexp_extract("file_path", "([^/]*/[^/]*)$", 1).alias("file"), "order_key", F.sha1(F.col("text").cast("binary")).alias("h"))
    # a file holds SHARD_SIZE lines at most
    return lines.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), F.array_sort(F.collect_list(F.struct("order_key", "h"))).alias("s")).select(
        "file", "n_rows", F.sha1(F.array_join(F.transform("s", lambda x: x.h), ",").cast("binary")).alias("rows_sha1"))
