"""Candidate pairs of documents: sifted by parity sketches, verified on their full shingle sets.

A shingle flips one bit of a sketch, so shingles that two sets share cancel out,
and the Hamming distance of two sketches is at most the size of the symmetric
difference: no linked pair is sifted out. Verification takes the sets again from
the whole texts. The texts of a document's partners come to it, in groups of
``CHUNK`` partners, each with its own copy of the document: no text comes twice
to one group, and no group grows with the number of copies.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import textops
from quarry.session import stage

WORDS = 16
CHUNK = 512
ID_ROWS = 2_000_000


def parity(s: np.ndarray, words: int) -> np.ndarray:
    """A sketch of 64 * words bits: each shingle flips one."""
    flips = np.bincount((s % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.uint64)


def sketch(s: np.ndarray) -> np.ndarray:
    """The sketch by which pairs are sifted; empty for the empty set."""
    return parity(s >> np.uint64(24), WORDS) if len(s) else np.zeros(0, np.uint64)


def lists(parts: list[np.ndarray]) -> pa.ListArray:
    """An Arrow column of uint64 arrays, as bigint."""
    offsets = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def may_link(n, m, apart, num: int, den: int):
    """Size filter and Hamming filter; on columns and numpy arrays alike."""
    return (n * den >= m * num) & (m * den >= n * num) & (apart * (den + num) <= (n + m) * (den - num))


def apart(a: str, b: str) -> Column:
    """Hamming distance of two sketch columns."""
    return functools.reduce(Column.__add__, [F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))) for k in range(WORDS)])


def sifted(pairs: DataFrame, sizes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (id_a, id_b) that pass the filters; ``sizes``: id, n, bits."""
    both = pairs.join(sizes.toDF("id_a", "n", "bits"), "id_a").join(sizes.toDF("id_b", "m", "bits_b"), "id_b")
    return both.where(may_link(F.col("n"), F.col("m"), apart("bits", "bits_b"), num, den)).select("id_a", "id_b").distinct()


def _verify_batches(width: int, num: int, den: int):
    """Links among rows sorted by (id_a, part, id_b): the texts of id_a itself (null id_b) come first."""
    def linked(batches):
        at, own = None, []
        for batch in batches:
            groups = list(zip(batch.column("id_a").to_pylist(), batch.column("part").to_pylist()))
            others = batch.column("id_b").to_pylist()
            found = []
            for lo, hi, data, offsets in textops.slices(batch, "text"):
                for row, s in zip(range(lo, hi), textops.shingle_sets(data, offsets, width)):
                    if groups[row] != at:
                        at, own = groups[row], []
                    if others[row] is None:
                        own.append(s)
                        continue
                    for t in own:
                        both = len(np.intersect1d(s, t, assume_unique=True))
                        if both and den * both >= num * (len(s) + len(t) - both):
                            found.append((at[0], others[row]))
                            break
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["id_a", "id_b"])
    return linked


def verified(pairs: DataFrame, docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The staged pairs (id_a, id_b) that are linked by their full sets."""
    parts = pairs.groupBy("id_a").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("parts"))
    cut = pairs.join(parts, "id_a").select(
        F.col("id_b").alias("doc_id"), "id_a", F.pmod(F.xxhash64("id_b"), F.col("parts")).cast("int").alias("part"), "id_b")
    own = parts.select(F.col("id_a").alias("doc_id"), "id_a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                       F.lit(None).cast("bigint").alias("id_b"))
    wanted = stage(cut.union(own), "pair-texts")
    if wanted.count() <= ID_ROWS:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, "doc_id").select("id_a", "part", "id_b", "text")
    return stage(texts.repartition("id_a", "part").sortWithinPartitions("id_a", "part", F.col("id_b").asc_nulls_first()).mapInArrow(
        _verify_batches(width, num, den), "id_a bigint, id_b bigint").distinct(), "pair-links")
