"""Token-bigram language model with add-k smoothing, trained and applied in Spark.

Stands in for the causal-LM forward pass: it produces the same score table
shape, ``(key, nll, n_tokens)``, which the perplexity and multiple-choice
aggregates consume (any external score table of that shape works too).

  sequence   w_0 = BOS, w_1..w_n, EOS           (n_tokens = n + 1 predicted positions)
  p(w | v)   = (c(v, w) + k) / (c(v) + k * |V|) (|V| = vocabulary ids incl. reserved)
  nll        = sum of round(-ln p * 1e6)        (BIGINT micro-nats: exact in any order)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.tokens import BOS, EOS
from quarry.session import stage

MICRO = 1_000_000
MODEL_ROWS = 4_000_000
BLOCK = 1 << 17


def _pairs(df: DataFrame, key_col: str, ids_col: str) -> DataFrame:
    seq = F.concat(F.array(F.lit(BOS)), F.col(ids_col), F.array(F.lit(EOS)))
    n = F.size(seq) - 1
    z = F.arrays_zip(F.slice(seq, 1, n).alias("v"), F.slice(seq, 2, n).alias("w"))
    return df.select(key_col, F.explode(z).alias("_p")).select(key_col, F.col("_p.v").alias("v"), F.col("_p.w").alias("w"))


def train(df: DataFrame, key_col: str = "doc_id", ids_col: str = "ids") -> tuple[DataFrame, DataFrame]:
    """(bigrams(v, w, c), contexts(v, cv)) counted over the training rows; both materialized."""
    pairs = _pairs(df, key_col, ids_col)
    bigrams = stage(pairs.groupBy("v", "w").agg(F.count(F.lit(1)).alias("c")), "lm-bigrams")
    contexts = stage(bigrams.groupBy("v").agg(F.sum("c").alias("cv")), "lm-contexts")
    return bigrams, contexts


def _terms(c: np.ndarray, cv: np.ndarray, n_ids: int, k: float) -> np.ndarray:
    """round(-ln p * 1e6) of pairs seen c times after contexts seen cv times."""
    return np.floor(-np.log((c + float(k)) / (cv + float(k) * n_ids)) * MICRO + 0.5).astype(np.int64)


def _looked_up(df: DataFrame, model: tuple[DataFrame, DataFrame], n_ids: int, k: float, key_col: str, ids_col: str) -> DataFrame:
    """``nll`` by a lookup in the broadcast model: no pair is shuffled."""
    tables = []
    for names, part in zip((("v", "w", "c"), ("v", "cv")), model):
        held = part.select(*names).toArrow()
        cols = [held.column(x).to_numpy().astype(np.int64) for x in names]
        at = cols[0] << 32 | cols[1] if len(cols) == 3 else cols[0]
        order = np.argsort(at)
        tables.append((at[order], cols[-1][order]))
    shared = df.sparkSession.sparkContext.broadcast(tables)
    rows = df.select(key_col, F.col(ids_col).cast("array<int>").alias("_ids")).where("_ids is not null")
    schema = rows.select(key_col, F.lit(0).cast("bigint").alias("nll"), F.lit(0).cast("bigint").alias("n_tokens")).schema

    def count(table, wanted):
        at, counts = table
        if not len(at):
            return np.zeros(len(wanted), dtype=np.int64)
        place = np.minimum(np.searchsorted(at, wanted), len(at) - 1)
        return np.where(at[place] == wanted, counts[place], 0)

    def score(batches):
        bigrams, contexts = shared.value
        for batch in batches:
            lists = batch.column("_ids")
            flat, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
            offsets = offsets - offsets[0]
            total, sizes = np.zeros(batch.num_rows, dtype=np.int64), np.diff(offsets) + 1
            lo = 0
            while lo < batch.num_rows:  # rows of about BLOCK ids at a time
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BLOCK, side="right")) - 1)
                ids, at = flat[offsets[lo]:offsets[hi]].astype(np.int64), offsets[lo:hi + 1] - offsets[lo]
                v, w = np.insert(ids, at[:-1], BOS), np.insert(ids, at[1:], EOS)
                terms = _terms(count(bigrams, v << 32 | w), count(contexts, v), n_ids, k)
                total[lo:hi] = np.add.reduceat(terms, at[:-1] + np.arange(hi - lo))
                lo = hi
            yield pa.RecordBatch.from_arrays([batch.column(key_col), pa.array(total), pa.array(sizes)], names=[key_col, "nll", "n_tokens"])

    return rows.mapInArrow(score, schema)


def _joined(df: DataFrame, model: tuple[DataFrame, DataFrame], n_ids: int, k: float, key_col: str, ids_col: str) -> DataFrame:
    """``nll`` by joins, for a model too large to broadcast."""
    bigrams, contexts = model
    # repeated pairs inside a row are counted first, so a hot pair costs one lookup per row
    pairs = _pairs(df, key_col, ids_col).groupBy(key_col, "v", "w").agg(F.count(F.lit(1)).alias("m"))
    looked = pairs.join(bigrams, ["v", "w"], "left").join(contexts, "v", "left")
    p = (F.coalesce("c", F.lit(0)) + F.lit(float(k))) / (F.coalesce("cv", F.lit(0)) + F.lit(float(k) * n_ids))
    term = F.round(-F.log(p) * MICRO).cast("bigint")
    return looked.groupBy(key_col).agg(F.sum(term * F.col("m")).alias("nll"), F.sum("m").alias("n_tokens"))


def nll(df: DataFrame, model: tuple[DataFrame, DataFrame], n_ids: int, k: float = 1.0, key_col: str = "doc_id",
        ids_col: str = "ids", model_rows: int = MODEL_ROWS) -> DataFrame:
    """(key, nll, n_tokens) per row with ids. Keys are unique; ``n_ids`` = |V| (all ids the tokenizer can emit).

    A model of at most ``model_rows`` bigrams (counted; 16 bytes each) is broadcast, a larger one joined.
    """
    small = model[0].count() <= model_rows
    return (_looked_up if small else _joined)(df, model, n_ids, k, key_col, ids_col)
