"""Registered queries: vocabulary, tokenize, truncate, fertility, packing, instruction formatting."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as TX
from quarry.operators import instructions as INS
from quarry.operators import tokens as TK
from quarry.operators.plugins import Plugin
from quarry.plans import sql as S
from quarry.plans.options import PackOptions
from quarry.plans.q_sampling import kept
from quarry.plans.registry import query, table
from quarry.session import stage

VOCAB = 4096
MAX_LEN = 512
PACK = PackOptions(seq_len=512, buckets=4, seed=42)

TOKEN_SQL = TK.TOKEN_RE


def tokens_sql(x: str) -> str:
    return f"regexp_extract_all({x}, '{TOKEN_SQL}')"


_VOCAB_CTE = f"""{S.kept()},
tok AS (SELECT doc_id, source, norm_text, {tokens_sql('norm_text')} AS toks FROM kept),
cnt AS (SELECT t AS token, count(*) AS count FROM (SELECT unnest(toks) AS t FROM tok) GROUP BY t),
vocab AS (SELECT token, count, CAST(row_number() OVER (ORDER BY count DESC, token) + 3 AS INTEGER) AS id FROM cnt
          QUALIFY row_number() OVER (ORDER BY count DESC, token) <= {VOCAB}),
pos AS (SELECT doc_id, unnest(toks) AS token, unnest(range(1, len(toks) + 1)) AS pos FROM tok),
ids AS (SELECT p.doc_id, list(coalesce(v.id, 1) ORDER BY p.pos) AS ids FROM pos p LEFT JOIN vocab v USING (token)
        GROUP BY p.doc_id)"""


def _kept_text(spark, sf_dir):
    return kept(spark, sf_dir).select("doc_id", "source", F.col("norm_text").alias("text"))


def _vocab_and_ids(spark, sf_dir):
    docs = _kept_text(spark, sf_dir)
    vocab = TK.build_vocab(docs, "text", VOCAB)
    return vocab, TK.tokenize(docs, vocab, "text", "doc_id", carry=("source",))


@query("build_vocab", f"WITH {_VOCAB_CTE} SELECT token, id FROM vocab")
def q_build_vocab(spark, sf_dir):
    return TK.build_vocab(_kept_text(spark, sf_dir), "text", VOCAB).select("token", "id")


@query("tokenize", f"WITH {_VOCAB_CTE} SELECT doc_id, len(ids) AS n_tokens, sha1(array_to_string(ids, ',')) AS ids_sha1 FROM ids")
def q_tokenize(spark, sf_dir):
    _, ids = _vocab_and_ids(spark, sf_dir)
    return ids.select("doc_id", F.size("ids").alias("n_tokens"), TK.ids_sha1(F.col("ids")).alias("ids_sha1"))


@query("truncate_tokens", f"WITH {_VOCAB_CTE} SELECT doc_id, least(len(ids), {MAX_LEN}) AS n_tokens, "
       f"sha1(array_to_string(list_slice(ids, 1, {MAX_LEN}), ',')) AS ids_sha1 FROM ids")
def q_truncate_tokens(spark, sf_dir):
    _, ids = _vocab_and_ids(spark, sf_dir)
    t = TK.truncate(F.col("ids"), MAX_LEN)
    return ids.select("doc_id", F.size(t).alias("n_tokens"), TK.ids_sha1(t).alias("ids_sha1"))


@query("token_fertility", f"""WITH {_VOCAB_CTE}
SELECT k.source, round(sum(len(i.ids)) / sum(len(string_split(k.norm_text, ' '))), 6) AS fertility
FROM kept k JOIN ids i USING (doc_id) GROUP BY k.source""")
def q_token_fertility(spark, sf_dir):
    docs = _kept_text(spark, sf_dir)
    vocab = TK.build_vocab(docs, "text", VOCAB)
    ids = TK.tokenize(docs.withColumn("n_words", F.size(F.split("text", " "))), vocab, "text", "doc_id",
                      carry=("source", "n_words"))
    return ids.groupBy("source").agg(
        F.round(F.sum(F.size("ids")) / F.sum("n_words"), 6).alias("fertility"))


_PACK_SQL = f"""WITH {_VOCAB_CTE},
d AS (SELECT doc_id, list_concat(ids, [3]) AS seq, {S.seeded_hash(PACK.seed, 'doc_id')} AS h FROM ids),
b AS (SELECT *, CAST(CAST(('0x' || substr(h, 1, 8)) AS UBIGINT) % {PACK.buckets} AS INTEGER) AS bucket,
      CAST(len(seq) AS BIGINT) AS n FROM d),
o AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY bucket ORDER BY h, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off FROM b),
c AS (SELECT bucket, off, n, seq, unnest(range(off // {PACK.seq_len}, (off + n - 1) // {PACK.seq_len} + 1)) AS chunk FROM o),
p AS (SELECT bucket, chunk, off, seq, greatest(chunk * {PACK.seq_len}, off) AS st,
      least((chunk + 1) * {PACK.seq_len}, off + n) AS en FROM c),
q AS (SELECT bucket, chunk, st, list_slice(seq, st - off + 1, en - off) AS piece FROM p),
g AS (SELECT bucket, chunk, flatten(list(piece ORDER BY st)) AS toks FROM q GROUP BY bucket, chunk)
SELECT bucket, chunk, len(toks) AS n_tokens, sha1(array_to_string(toks, ',')) AS tokens_sha1 FROM g"""


@query("pack_sequences", _PACK_SQL)
def q_pack_sequences(spark, sf_dir):
    _, ids = _vocab_and_ids(spark, sf_dir)
    packed = TK.pack(ids, PACK)
    return packed.select("bucket", "chunk", "n_tokens", TK.ids_sha1(F.col("tokens")).alias("tokens_sha1"))


def _code_points():
    """A user's tokenizer: the id of a character is its code point and the reserved ids."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def ids(texts):
        flat = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), dtype=np.uint32).astype(np.int32)
        ends = np.cumsum([0, *pc.utf8_length(texts).to_pylist()], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat + TK.N_RESERVED))
    return ids


@query("pack_user_tokenizer", _PACK_SQL.replace(f"WITH {_VOCAB_CTE},", f"""WITH {S.kept()},
ids AS (SELECT doc_id, list_transform(regexp_extract_all(norm_text, '(?s).'), lambda c: unicode(c) + {TK.N_RESERVED}) AS ids FROM kept),"""))
def q_pack_user_tokenizer(spark, sf_dir):
    """The kept documents packed with the ids of a user's tokenizer."""
    ids = TK.tokenize_with(_kept_text(spark, sf_dir), Plugin(_code_points, "code points"), "text", "doc_id")
    return TK.pack(ids, PACK).select("bucket", "chunk", "n_tokens", TK.ids_sha1(F.col("tokens")).alias("tokens_sha1"))


_CUE_SQL = "chr(10) || 'Odpowiedz: '"


@query("format_instructions", f"WITH {S.pairs()} SELECT conv_id || ':' || turn AS id, "
       f"sha1(prompt || {_CUE_SQL} || response) AS text_sha1 FROM pairs")
def q_format_instructions(spark, sf_dir):
    pairs = INS.format_instructions(INS.conversation_pairs(table(spark, sf_dir, "conversations")))
    return pairs.select(F.concat_ws(":", "conv_id", "turn").alias("id"), TX.text_sha1(F.col("text")).alias("text_sha1"))


@query("loss_mask", f"WITH {S.pairs()} SELECT conv_id || ':' || turn AS id, "
       f"len({tokens_sql('prompt || ' + _CUE_SQL)}) AS n_masked, len({tokens_sql('response')}) AS n_scored FROM pairs")
def q_loss_mask(spark, sf_dir):
    pairs = INS.conversation_pairs(table(spark, sf_dir, "conversations"))
    n_prompt = F.size(TK.token_strings(F.concat("prompt", F.lit(INS.ANSWER_CUE))))
    n_resp = F.size(TK.token_strings(F.col("response")))
    mask = INS.loss_mask(n_prompt, n_resp, completion_only=True)
    scored = F.aggregate(mask, F.lit(0), lambda acc, x: acc + x)
    return pairs.select(F.concat_ws(":", "conv_id", "turn").alias("id"), (F.size(mask) - scored).alias("n_masked"),
                        scored.alias("n_scored"))


_INSTR_CTE = f"""{_VOCAB_CTE}, {S.pairs()},
itok AS (SELECT 'inst:' || conv_id || ':' || turn AS id, {tokens_sql('prompt || ' + _CUE_SQL)} AS p, {tokens_sql('response')} AS r FROM pairs),
ipos AS (SELECT id, unnest(list_concat(p, r)) AS token, unnest(range(1, len(p) + len(r) + 1)) AS pos, len(p) AS np FROM itok),
rows_ AS (SELECT 'doc:' || doc_id AS id, ids, list_transform(ids, lambda x: 1) AS mask FROM ids
  UNION ALL SELECT i.id, list(coalesce(v.id, 1) ORDER BY i.pos), list(CASE WHEN i.pos > np THEN 1 ELSE 0 END ORDER BY i.pos)
  FROM ipos i LEFT JOIN vocab v USING (token) GROUP BY i.id)"""

_PACK_MASKED_SQL = f"""WITH {_INSTR_CTE},
d AS (SELECT id, list_concat(ids, [3]) AS seq, list_concat(mask, [1]) AS m, {S.seeded_hash(PACK.seed, 'id')} AS h FROM rows_),
b AS (SELECT *, CAST(CAST(('0x' || substr(h, 1, 8)) AS UBIGINT) % {PACK.buckets} AS INTEGER) AS bucket, CAST(len(seq) AS BIGINT) AS n FROM d),
o AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY bucket ORDER BY h, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off FROM b),
c AS (SELECT bucket, off, n, seq, m, unnest(range(off // {PACK.seq_len}, (off + n - 1) // {PACK.seq_len} + 1)) AS chunk FROM o),
p AS (SELECT *, greatest(chunk * {PACK.seq_len}, off) AS st, least((chunk + 1) * {PACK.seq_len}, off + n) AS en FROM c),
q AS (SELECT bucket, chunk, st, en - st AS k, list_slice(seq, st - off + 1, en - off) AS piece, list_slice(m, st - off + 1, en - off) AS mp FROM p),
g AS (SELECT bucket, chunk, flatten(list(piece ORDER BY st)) AS toks, sum(list_sum(mp)) AS n_scored, count(*) AS n_segments,
  sum(k * (k - 1) // 2) AS position_sum, max(k) - 1 AS last_position FROM q GROUP BY bucket, chunk)
SELECT bucket, chunk, len(toks) AS n_tokens, sha1(array_to_string(toks, ',')) AS tokens_sha1, CAST(n_scored AS BIGINT) AS n_scored,
  n_segments, CAST(position_sum AS BIGINT) AS position_sum, last_position FROM g"""


def _instruction_ids(spark, sf_dir, vocab):
    """(id, ids, mask) of every instruction pair, the prompt and its cue masked."""
    pairs = INS.conversation_pairs(table(spark, sf_dir, "conversations")).select(
        F.concat_ws(":", F.lit("inst"), "conv_id", "turn").alias("id"), F.concat("prompt", F.lit(INS.ANSWER_CUE)).alias("prompt"), "response")
    asked = TK.tokenize(pairs, vocab, "prompt", "id", out="p", carry=("response",))
    both = TK.tokenize(asked, vocab, "response", "id", out="r", carry=("p",))
    return both.select("id", F.concat("p", "r").alias("ids"), INS.loss_mask(F.size("p"), F.size("r")).alias("mask"))


@query("pack_masked", _PACK_MASKED_SQL)
def q_pack_masked(spark, sf_dir):
    """Corpus and instruction rows packed together with loss mask, segment ids and positions."""
    vocab, ids = _vocab_and_ids(spark, sf_dir)
    corpus = ids.select(F.concat(F.lit("doc:"), "doc_id").alias("id"), "ids", F.array_repeat(F.lit(1), F.size("ids")).alias("mask"))
    packed = TK.pack_masked(corpus.unionByName(_instruction_ids(spark, sf_dir, vocab)), PACK)
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return packed.select("bucket", "chunk", "n_tokens", TK.ids_sha1(F.col("tokens")).alias("tokens_sha1"), total("loss_mask").alias("n_scored"),
                         F.array_max("segment_ids").cast("bigint").alias("n_segments"), total("positions").alias("position_sum"),
                         F.array_max("positions").cast("bigint").alias("last_position"))


BATCH = 8


@query("collate_batches", f"""WITH {_INSTR_CTE},
t AS (SELECT id, list_slice(ids, 1, {MAX_LEN}) AS ids, list_slice(mask, 1, {MAX_LEN}) AS mask FROM rows_),
r AS (SELECT *, row_number() OVER (ORDER BY len(ids), id) - 1 AS rank FROM t),
b AS (SELECT *, rank // {BATCH} AS batch, CAST(rank % {BATCH} AS INTEGER) AS row, max(len(ids)) OVER (PARTITION BY rank // {BATCH}) AS width FROM r)
SELECT id, batch, row, CAST(width AS INTEGER) AS padded_length, CAST(len(ids) AS BIGINT) AS n_attended, CAST(coalesce(list_sum(mask), 0) AS BIGINT) AS n_unmasked,
  sha1(array_to_string(list_concat(ids, list_transform(range(0, width - len(ids)), lambda x: 3)), ',')) AS input_sha1,
  sha1(array_to_string(list_concat(list_transform(ids, lambda x, i: CASE WHEN mask[i] = 1 THEN x ELSE -100 END),
    list_transform(range(0, width - len(ids)), lambda x: -100)), ',')) AS labels_sha1 FROM b""")
def q_collate_batches(spark, sf_dir):
    """Truncated corpus and instruction rows in length-bucketed batches."""
    vocab, ids = _vocab_and_ids(spark, sf_dir)
    corpus = ids.select(F.concat(F.lit("doc:"), "doc_id").alias("id"), "ids", F.array_repeat(F.lit(1), F.size("ids")).alias("mask"))
    rows = corpus.unionByName(_instruction_ids(spark, sf_dir, vocab))
    rows = rows.select("id", TK.truncate(F.col("ids"), MAX_LEN).alias("ids"), TK.truncate(F.col("mask"), MAX_LEN).alias("mask"))
    out = TK.collate(stage(rows, "batch-rows"), BATCH, "id", mask_col="mask")
    return out.select("id", "batch", "row", "padded_length", F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_attended"),
                      F.size(F.filter("labels", lambda x: x != TK.IGNORED)).cast("bigint").alias("n_unmasked"),
                      TK.ids_sha1(F.col("input_ids")).alias("input_sha1"), TK.ids_sha1(F.col("labels")).alias("labels_sha1"))
