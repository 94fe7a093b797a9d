"""N-gram Jaccard join by parity sketches.

Documents are sets of 3-word shingles; two are linked when
``den * |A and B| >= num * |A or B|`` (90/100 in the query). Linked sets differ
in few shingles: in at most ``D(a) = a * (den - num) / num``, a the smaller size.

1. One pass hashes each whole text to its set, a fingerprint of the set and its
   parity sketches. A shingle flips one bit of a sketch, so shingles that two
   sets share cancel out, and the Hamming distance of two sketches is at most
   the size of the symmetric difference. Equal sets are one class; one row of a
   class goes on.
2. Sizes form bands (``RATIO``); a document is in its own band and in each lower
   one whose sets it can be linked with. A band whose largest size allows D
   differences cuts its sketch into words of 64 bits, one more than D and some
   spare: at least 1 + spare words of two linked sets are equal, and equal words
   are a key to meet by. A word of fewer than ``LEAST_BITS`` bits says little; a
   document that has at most ``spare`` of them leaves them out, and still
   shares another. Bands with D < ``PAIRED`` use pairs of words, of which two
   more than D leave one pair equal. So no link is lost in any band. With D = 0
   only equal sets are linked.
3. Documents that share a key meet its smallest one first, each at first the
   smallest of all it meets. Links merge components, and documents of one
   component need not meet. Keys whose documents are still of several components
   are then compared between these: up to ``SMALL`` documents by a join, more in
   units of ``chunk`` by ``chunk`` documents dealt over the tasks, each compared
   as a whole by its sketches, whatever the size of the key.
4. Every pair has to pass the size filter and the Hamming distance of sketches
   of one length, and is verified on the full sets (``pairs``).

Edge cases: a text without words, or null, has the empty set and is linked with
nothing. A null doc_id is linked with nothing, its component is null. Rows that
repeat a doc_id share its component: its links are those of any of its texts.
Ties go to the smallest doc_id. Empty tables give no rows. Extra columns are
ignored. Shingles are 64-bit hashes. Ids to look up are broadcast up to
``pairs.ID_ROWS`` rows (counted) and joined by a shuffle beyond.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import pairs, textops
from quarry.llm.registry import query, table
from quarry.operators.components import connected_components
from quarry.session import stage

WIDTH = 3
RATIO = 1.2
PAIRED = 8
LEAST_BITS = 3
SMALL = 32

SIGNATURE = "doc_id bigint, n bigint, fp1 bigint, fp2 bigint, bits array<bigint>, keys array<bigint>"


@functools.lru_cache(maxsize=None)
def differences(size: int, num: int, den: int) -> int:
    """The most shingles in which a set of ``size`` can differ from a linked one that is not smaller."""
    return size * (den - num) // num


@functools.lru_cache(maxsize=None)
def band_top(band: int) -> int:
    """The largest size of a band."""
    return 1 if band == 0 else int(band_top(band - 1) * RATIO) + 1


def bands_of(n: int, num: int, den: int) -> list[int]:
    """A size's own band and the lower ones whose largest sets can be linked with it."""
    band = 0
    while band_top(band) < n:
        band += 1
    out = [band]
    while band and n * num <= band_top(band - 1) * den:
        band -= 1
        out.append(band)
    return out


@functools.lru_cache(maxsize=None)
def _word_pairs(words: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(words, 1)


def band_keys(s: np.ndarray, band: int, num: int, den: int) -> np.ndarray:
    """Keys of a set in a band: two linked sets of the band share one at least."""
    most = differences(band_top(band), num, den)
    if most == 0:
        return np.zeros(0, np.uint64)
    salt = np.uint64(band) << np.uint64(40)
    if most < PAIRED:
        words = pairs.parity(s, most + 2)
        i, j = _word_pairs(most + 2)
        return textops.mix(textops.mix(words[i] ^ textops.mix(salt + i.astype(np.uint64))) + words[j] * np.uint64(3) + j.astype(np.uint64))
    spare = (most + 1) // 6 + 2
    words = pairs.parity(s, most + 1 + spare)
    keys = textops.mix(words ^ textops.mix(salt + np.arange(len(words), dtype=np.uint64)))
    strong = np.bitwise_count(words) >= LEAST_BITS
    return keys[strong] if len(words) - int(strong.sum()) <= spare else keys


def _signature_batches(num: int, den: int):
    none = np.zeros(0, np.uint64)

    def signatures(batches):
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            for lo, hi, data, offsets in textops.slices(batch, "text"):
                sets = textops.shingle_sets(data, offsets, WIDTH)
                prints = np.array([[textops.mix(s ^ np.uint64(salt)).sum(dtype=np.uint64) for s in sets]
                                   for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)], dtype=np.uint64)
                keys = [np.concatenate([band_keys(s, b, num, den) for b in bands_of(len(s), num, den)]) if len(s) else none for s in sets]
                bits = [pairs.sketch(s) for s in sets]  # of another part of the hash than the bands': the two say different things
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints[0].view(np.int64)),
                    pa.array(prints[1].view(np.int64)), pairs.lists(bits), pairs.lists(keys)],
                    names=["doc_id", "n", "fp1", "fp2", "bits", "keys"])
    return signatures


def _unit(num: int, den: int):
    """Pairs (id_a, id_b) of different components, of the documents of two chunks, that pass the filters."""
    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        (ia, la, na), (ib, lb, nb) = ([t.column(c).to_numpy() for c in ("id", "label", "n")] for t in (a, b))
        wa, wb = (t.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, pairs.WORDS) for t in (a, b))
        apart = np.zeros((len(ia), len(ib)), dtype=np.int64)
        for k in range(pairs.WORDS):
            apart += np.bitwise_count(wa[:, None, k] ^ wb[None, :, k])
        x, y = np.nonzero(pairs.may_link(na[:, None], nb[None, :], apart, num, den) & (la[:, None] != lb[None, :]))
        return pa.table({"id_a": np.minimum(ia[x], ib[y]), "id_b": np.maximum(ia[x], ib[y])})
    return compare


def _labelled(rows: DataFrame, labels: DataFrame | None, key: str = "id", out: str = "label") -> DataFrame:
    """``rows`` with the component of their id so far, else itself."""
    if labels is None:
        return rows.withColumn(out, F.col(key))
    return rows.join(labels.select(F.col("node").alias(key), F.col("label").alias("_l")), key, "left").withColumn(
        out, F.coalesce("_l", key)).drop("_l")


def links(reps: DataFrame, docs: DataFrame, num: int, den: int, small: int = SMALL, chunk: int = pairs.CHUNK) -> DataFrame | None:
    """(node, label) of every class representative that is linked with another; None without any.

    ``reps``: doc_id, n, bits, keys. ``docs``: doc_id, text.
    """
    sizes = reps.select(F.col("doc_id").alias("id"), "n", "bits")
    rows = reps.select(F.explode("keys").alias("key"), F.col("doc_id").alias("id"))
    shared = rows.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("_last"), F.count(F.lit(1)).alias("size")).where(
        F.col("first") < F.col("_last")).drop("_last")
    held = stage(rows.join(shared, "key"), "parity-keys")
    if held.isEmpty():
        return None
    labels, edges = None, []

    def confirm(candidates: DataFrame) -> None:
        """Take the links among candidates that passed the filters."""
        nonlocal labels
        candidates = stage(candidates, "parity-pairs")
        found = None if candidates.isEmpty() else pairs.verified(candidates, docs, WIDTH, num, den)
        if found is not None and not found.isEmpty():
            edges.append(found)
            labels = connected_components(functools.reduce(DataFrame.union, edges))

    star = stage(held.where("id <> first").select(F.col("first").alias("id_a"), F.col("id").alias("id_b")).distinct(), "parity-stars")
    nearest = star.groupBy("id_b").agg(F.min("id_a").alias("id_a")).select("id_a", "id_b")
    confirm(pairs.sifted(nearest, sizes, num, den))
    apart = _labelled(_labelled(star, labels, "id_a", "_a"), labels, "id_b", "_b").where("_a <> _b").select("id_a", "id_b")
    confirm(pairs.sifted(apart.join(nearest, ["id_a", "id_b"], "left_anti"), sizes, num, den))

    seen = stage(_labelled(held, labels), "parity-rows")
    parts = seen.groupBy("key", "label").agg(F.count(F.lit(1)).alias("m")).groupBy("key").agg(
        F.sum("m").alias("size"), F.max(F.struct("m", "label")).alias("main"), F.count(F.lit(1)).alias("parts"))
    left = stage(seen.drop("size").join(parts.where("parts > 1").drop("parts"), "key").select(
        "key", "id", "label", "size", F.col("main.label").alias("main"), F.col("main.m").alias("m")).join(sizes, "id"), "parity-left")
    if left.isEmpty():
        return labels
    a, b = left.where((F.col("size") <= small) & (F.col("label") != F.col("main"))).alias("a"), left.alias("b")
    few = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.label") != F.col("b.label"))
                 & pairs.may_link(F.col("a.n"), F.col("b.n"), pairs.apart("a.bits", "b.bits"), num, den)).select(
        F.least("a.id", "b.id").alias("id_a"), F.greatest("a.id", "b.id").alias("id_b")).distinct()
    many = left.where(F.col("size") > small)
    met = few
    if not many.isEmpty():
        # few documents outside the main component against all, in chunks of both
        many = many.withColumn("na", F.ceil((F.col("size") - F.col("m")) / chunk).cast("int")).withColumn(
            "nb", F.ceil(F.col("size") / chunk).cast("int"))
        of = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        unit = ["key", "ca", "cb"]
        x = many.where("label <> main").select("key", of("na").alias("ca"), every("nb").alias("cb"), "id", "label", "n", "bits")
        y = many.select("key", every("na").alias("ca"), of("nb").alias("cb"), "id", "label", "n", "bits").toDF(*x.columns)
        met = few.union(x.groupBy(*unit).cogroup(y.groupBy(*unit)).applyInArrow(_unit(num, den), "id_a bigint, id_b bigint")).distinct()
    confirm(met.join(star, ["id_a", "id_b"], "left_anti"))
    return labels


def components(docs: DataFrame, num: int = 90, den: int = 100, small: int = SMALL, chunk: int = pairs.CHUNK,
               text_col: str = "text", key_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    docs = docs.select(F.col(key_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    # the row number makes one row of a class its representative, also when ids repeat
    signed = stage(docs.mapInArrow(_signature_batches(num, den), SIGNATURE).withColumn("row", F.monotonically_increasing_id()),
                   "parity-signatures")
    whole = signed.where("n > 0 and doc_id is not null")
    classes = whole.groupBy("n", "fp1", "fp2").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("m")).where("m > 1")
    members = stage(signed.select("doc_id", "n", "fp1", "fp2", "row").join(classes.drop("m"), ["n", "fp1", "fp2"], "left").select(
        "doc_id", "n", "row", F.when(F.col("doc_id").isNotNull(), F.coalesce("first.doc_id", "doc_id")).alias("rep"),
        F.coalesce("first.row", "row").alias("rep_row")), "parity-members")
    reps = whole.join(members.where("row <> rep_row").select("row"), "row", "left_anti").select("doc_id", "n", "bits", "keys")
    found = links(reps, docs, num, den, small, chunk)
    # a doc_id that repeats with other texts ties the classes of these
    span = members.where("rep is not null").groupBy("doc_id").agg(F.min("rep").alias("id_a"), F.max("rep").alias("hi")).where("id_a < hi").drop("hi")
    ties = stage(members.join(span, "doc_id").select("id_a", F.col("rep").alias("id_b")).distinct(), "parity-ties")
    if not ties.isEmpty():
        found = connected_components(ties if found is None else ties.union(found.select(F.col("node").alias("id_a"), F.col("label").alias("id_b"))))
    out = members if found is None else members.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.col("rep") if found is None else F.coalesce("label", "rep")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) END AS sh FROM w),
size AS (SELECT doc_id, len(sh) AS n FROM sets),
item AS MATERIALIZED (SELECT doc_id, unnest(sh) AS s FROM sets),
met AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM item a JOIN item b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (
  SELECT x, y FROM met JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * common >= 90 * (p.n + q.n - common)),
two AS MATERIALIZED (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id, doc_id AS r FROM size UNION SELECT reach.doc_id, two.y FROM reach JOIN two ON two.x = reach.r)
SELECT size.doc_id, CAST(n AS BIGINT) AS n_shingles, min(r) AS component_id
FROM size JOIN reach ON reach.doc_id = size.doc_id GROUP BY size.doc_id, n
"""


@query("op13_ngram_jaccard_join", _SQL)
def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "documents"))
