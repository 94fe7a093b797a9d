"""Tokenize and pack.

Tokenizer: words (letter runs), number runs and single symbols, mapped to ids
through a corpus-trained vocabulary (ids 0-3 reserved: pad, unk, bos, eos).
A user tokenizer can replace it (``tokenize_with``), or any table with ``ids``.

Packing concatenates documents (EOS after each) in seeded-hash order inside a
bucket and cuts fixed-length chunks. The token offset of each document is an
exclusive prefix sum computed on a narrow (bucket, hash, n) projection with
bucketed offsets (see ``sampling.global_rank``), so no window sorts a whole
bucket's token arrays; every chunk group holds at most ``seq_len`` tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import WS_CHARS
from quarry.operators import plugins, sampling
from quarry.plans.options import PackOptions
from quarry.session import stage

# Reserved ids.
PAD, UNK, BOS, EOS = 0, 1, 2, 3
N_RESERVED = 4
SLICE = 1 << 18  # list items that a task works on at a time
TOKEN_RE = f"\\p{{L}}+|\\p{{N}}+|[^\\p{{L}}\\p{{N}}{WS_CHARS}]"


def token_strings(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(TOKEN_RE), 0)


def _tokens_of(df: DataFrame, col: str) -> Column:
    """The tokens of a text column; a column of token arrays, split before, is taken as it is."""
    if isinstance(df.schema[col].dataType, T.ArrayType):
        return F.col(col)
    return token_strings(F.col(col))


def build_vocab(df: DataFrame, text_col: str = "text", vocab_size: int = 32_000) -> DataFrame:
    """(token, id, count): the ``vocab_size`` most frequent tokens, ties by token; ids from 4.

    ``text_col`` holds texts, or their tokens (``token_strings``) where those serve more than one step.
    The top-k merge keeps at most vocab_size rows per partition, and the id
    window runs over those vocab_size rows only.
    """
    counts = df.select(F.explode(_tokens_of(df, text_col)).alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("count"))
    top = counts.orderBy(F.col("count").desc(), F.col("token")).limit(vocab_size)
    w = Window.orderBy(F.col("count").desc(), F.col("token"))
    # the vocabulary is a model artifact read by every tokenize job: materialize it once
    return stage(top.withColumn("id", (F.row_number().over(w) + (N_RESERVED - 1)).cast("int")), "vocab")


def list_slices(batch: pa.RecordBatch, col: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows of about ``limit`` list items of ``col``; a longer list is a run of its own."""
    offsets = batch.column(col).offsets.to_numpy()
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield batch.slice(lo, min(hi, batch.num_rows) - lo)
        lo = hi


def tokenize(df: DataFrame, vocab: DataFrame, text_col: str = "text", key_col: str = "doc_id",
             out: str = "ids", carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, *carry, ids): ``ids`` is array<int> in document token order, unknown tokens -> 1.

    The JVM splits the text; the ids come from an Arrow lookup of the batch's
    flattened tokens in the vocabulary (broadcast: ``vocab_size`` rows bound it),
    so no token is shuffled. Documents without tokens get an empty array.
    """
    held = vocab.select("token", "id").toArrow()
    shared = df.sparkSession.sparkContext.broadcast((held.column("token").combine_chunks(), held.column("id").to_numpy()))
    rows = df.select(key_col, *carry, F.coalesce(_tokens_of(df, text_col), F.array().cast("array<string>")).alias("_t"))
    schema = df.select(key_col, *carry, F.array().cast("array<int>").alias(out)).schema

    def look_up(batches):
        tokens, ids = shared.value
        for batch in batches:
            for part in list_slices(batch, "_t"):
                lists = part.column("_t")
                at = pc.index_in(lists.flatten(), value_set=tokens)
                found = np.where(at.is_valid().to_numpy(zero_copy_only=False), ids[at.fill_null(0).to_numpy()] if len(ids) else UNK, UNK)
                offsets = lists.offsets.to_numpy()
                made = pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), pa.array(found, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in (key_col, *carry)), made], names=[key_col, *carry, out])

    return rows.mapInArrow(look_up, schema)


def tokenize_with(df: DataFrame, tokenizer: plugins.Plugin, text_col: str = "text", key_col: str = "doc_id",
                  out: str = "ids", carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, *carry, ids) by a user's tokenizer, in the shape of ``tokenize``; a null text has no ids.

    The ids are the tokenizer's own: ``pack`` and ``collate`` add EOS 3 and pad as asked for.
    """
    return df.select(key_col, *carry, plugins.token_ids(tokenizer, F.col(text_col)).alias(out))


def ids_sha1(c: Column) -> Column:
    return F.sha1(F.concat_ws(",", c.cast("array<string>")).cast("binary"))


def truncate(ids: Column, max_len: int) -> Column:
    return F.slice(ids, 1, max_len)


def pad_to(ids: Column, length: Column, pad_id: int = PAD) -> Column:
    """Right-pad to ``length`` (export only; packed chunks need no padding)."""
    return F.concat(ids, F.array_repeat(F.lit(pad_id), F.greatest(length - F.size(ids), F.lit(0)).cast("int")))


def attention_mask(ids: Column, length: Column) -> Column:
    return F.concat(F.array_repeat(F.lit(1), F.size(ids)),
                    F.array_repeat(F.lit(0), F.greatest(length - F.size(ids), F.lit(0)).cast("int")))


def pack(df: DataFrame, opts: PackOptions = PackOptions(), key_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(bucket, chunk, tokens, n_tokens) chunks of ``seq_len`` tokens (EOS after each document).

    The last chunk of each bucket is shorter; ``keep_partial=False`` drops it.
    """
    L = opts.seq_len
    seq = F.col(ids_col)
    if opts.add_bos:
        seq = F.concat(F.array(F.lit(BOS)), seq)
    seq = F.concat(seq, F.array(F.lit(EOS)))
    h = sampling.seeded_hash(opts.seed, F.col(key_col))
    docs = df.select(key_col, seq.alias("_seq")).withColumn("_h", h).withColumn(
        "bucket", (F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") % F.lit(opts.buckets)).cast("int")
    ).withColumn("_n", F.size("_seq").cast("bigint"))
    docs = stage(docs, "pack-input")  # read twice below: offsets and pieces
    narrow = docs.select(key_col, "bucket", "_h", "_n")
    offs = sampling.global_rank(narrow, "_h", key_col, ["bucket"], digits=3, out="_off", value_col="_n")
    placed = docs.join(offs.select(key_col, "_off"), on=key_col)
    off, n = F.col("_off"), F.col("_n")
    chunks = placed.withColumn("chunk", F.explode(F.sequence((off / L).cast("bigint"), ((off + n - 1) / L).cast("bigint"))))
    st = F.greatest(F.col("chunk") * L, off)
    en = F.least((F.col("chunk") + 1) * L, off + n)
    pieces = chunks.select("bucket", "chunk", st.alias("_st"),
                           F.slice("_seq", (st - off + 1).cast("int"), (en - st).cast("int")).alias("_piece"))
    packed = pieces.groupBy("bucket", "chunk").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_st", "_piece"))), lambda z: z["_piece"])).alias("tokens"))
    packed = packed.withColumn("n_tokens", F.size("tokens"))
    if not opts.keep_partial:
        packed = packed.where(F.col("n_tokens") == L)
    return packed


def pack_masked(df: DataFrame, opts: PackOptions = PackOptions(), key_col: str = "id", ids_col: str = "ids",
                mask_col: str = "mask") -> DataFrame:
    """(bucket, chunk, tokens, loss_mask, segment_ids, positions, n_tokens): packed chunks with parallel arrays.

    Rows are packed as by ``pack``, and the mask (1: scored) is cut at the same
    offsets; the EOS of a row is scored. ``segment_ids`` numbers a chunk's
    documents from 1, ``positions`` counts from 0 in each of them, so a document
    that a chunk border cuts starts anew: its parts do not see each other.
    Corpus and instruction rows mix freely, a corpus row has a mask of ones. A
    null mask scores everything; a mask of another length than the ids fails.
    """
    size, ids = opts.seq_len, F.coalesce(F.col(ids_col), F.array().cast("array<int>"))
    mask = F.coalesce(F.col(mask_col), F.array_repeat(F.lit(1), F.size(ids)))
    mask = F.when(F.size(mask) == F.size(ids), mask).otherwise(F.raise_error(F.lit("loss mask and ids differ in length")).cast("array<int>"))
    start = [F.array(F.lit(BOS))] if opts.add_bos else []
    seq = F.concat(*start, ids, F.array(F.lit(EOS)))
    scored = F.concat(*[F.array(F.lit(0)) for _ in start], mask, F.array(F.lit(1)))
    rows = stage(df.select(key_col, F.arrays_zip(seq.alias("t"), scored.alias("m")).alias("_seq"),
                           sampling.seeded_hash(opts.seed, F.col(key_col)).alias("_h")).select(
        "*", (F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") % F.lit(opts.buckets)).cast("int").alias("bucket"),
        F.size("_seq").cast("bigint").alias("_n")), "pack-rows")
    offsets = sampling.global_rank(rows.select(key_col, "bucket", "_h", "_n"), "_h", key_col, ["bucket"], digits=3, out="_off", value_col="_n")
    off, n = F.col("_off"), F.col("_n")
    placed = rows.join(offsets.select(key_col, "_off"), key_col).withColumn(
        "chunk", F.explode(F.sequence((off / size).cast("bigint"), ((off + n - 1) / size).cast("bigint"))))
    begin, end = F.greatest(F.col("chunk") * size, off), F.least((F.col("chunk") + 1) * size, off + n)
    pieces = placed.select("bucket", "chunk", F.struct(
        begin.alias("at"), F.slice("_seq", (begin - off + 1).cast("int"), (end - begin).cast("int")).alias("p")).alias("z"))
    whole = pieces.groupBy("bucket", "chunk").agg(F.array_sort(F.collect_list("z")).alias("zs"))
    packed = whole.select(
        "bucket", "chunk",
        F.flatten(F.transform("zs", lambda z: z.p.getField("t"))).alias("tokens"),
        F.flatten(F.transform("zs", lambda z: z.p.getField("m"))).alias("loss_mask"),
        F.flatten(F.transform("zs", lambda z, i: F.array_repeat(i + 1, F.size(z.p)))).alias("segment_ids"),
        F.flatten(F.transform("zs", lambda z: F.sequence(F.lit(0), F.size(z.p) - 1))).alias("positions"))
    packed = packed.withColumn("n_tokens", F.size("tokens"))
    return packed if opts.keep_partial else packed.where(F.col("n_tokens") == size)


IGNORED = -100  # fixed value: the label that a loss leaves out


def collate(df: DataFrame, batch_size: int, key_col: str = "doc_id", ids_col: str = "ids", pad_id: int | None = None,
            mask_col: str | None = None) -> DataFrame:
    """(key, batch, row, padded_length, input_ids, attention_mask, labels): batches of rows of similar length.

    Rows are ranked by (length, key), so a batch pads little; it is padded on the
    right to its longest row, with ``pad_id`` or, unset, EOS. Labels are the ids,
    ``IGNORED`` on padding and where ``mask_col`` (1: scored) is 0. Only (key,
    length) rows are ranked; the ids are joined once by key. Keys are unique;
    null ids are an empty row, a null mask scores everything.
    """
    ids = F.coalesce(F.col(ids_col), F.array().cast("array<int>"))
    held = df.select(key_col, ids.alias("_ids"), *([F.coalesce(mask_col, F.array_repeat(F.lit(1), F.size(ids))).alias("_mask")] if mask_col else []))
    ranked = stage(sampling.order_rank(held.select(F.size("_ids").alias("_n"), key_col), ["_n", key_col]), "batch-ranks").select(
        key_col, "_n", F.floor(F.col("rank") / batch_size).cast("bigint").alias("batch"), (F.col("rank") % batch_size).cast("int").alias("row"))
    longest = ranked.groupBy("batch").agg(F.max("_n").alias("padded_length"))
    rows = held.join(ranked.join(longest, "batch"), key_col)
    attention = attention_mask(F.col("_ids"), F.col("padded_length"))
    padded = pad_to(F.col("_ids"), F.col("padded_length"), EOS if pad_id is None else pad_id)
    scored = F.zip_with("_ids", "_mask", lambda t, m: F.when(m == 1, t).otherwise(F.lit(IGNORED))) if mask_col else F.col("_ids")
    return rows.select(key_col, "batch", "row", "padded_length", padded.alias("input_ids"), attention.alias("attention_mask"),
                       pad_to(scored, F.col("padded_length"), IGNORED).alias("labels"))
