"""Near-duplicate documents by a chosen-path set similarity join.

Documents are sets of 5-word shingles. Two are linked when
``den * |A and B| >= num * |A or B|`` (85/100 in the query); linked documents
form components, of which the smallest doc_id stays.

1. One pass hashes each whole text to its set, a fingerprint of the set and
   ``COORDS`` minwise tokens. Documents with the same set are one class; only a
   class's first row goes on, so copies cost nothing further.
2. Independent trees branch each document by minwise tokens. At the root of a
   tree a document goes to ``BRANCH`` children, one for each chosen token; as
   many trees are taken as ``recall`` asks for at the threshold.
3. In every node the other documents are first compared with the smallest one.
   Links merge components, and a node whose members are all of one component is
   done: no pair in it can change the result. In what is left, a node of at most
   ``SMALL`` documents, or with at most ``SMALL`` outside its main component, is
   compared exhaustively between components. The documents of the others go two
   levels down at once: each goes to the nodes of ``pairs_for`` pairs of further
   minwise tokens, so that a text that many documents have in common keeps
   together the square of its share of them. Nodes that stay large are ended by an
   exact prefix-filter join: shingles are ordered by rarity (counted over their
   documents in ``BUCKETS`` hash buckets), and documents at the threshold share one
   of the first ``n - ceil(t n) + 1``. Each such shingle is a node, compared in the
   same way, and with a positional filter, whatever its size. Where the threshold
   asks for more tokens than ``COORDS``, the prefix join follows the roots.
4. Candidates must pass the size filter (exact) and a filter on 64 one-bit
   minwise tokens (``bits_apart``, from the threshold: a pair there fails it with
   a probability below 1e-9), then the Hamming distance of parity sketches
   (exact), inside the exhaustive comparison of a node and before any pair is
   written. What is left is verified on the full sets (``pairs``); ids are
   broadcast up to ``ID_ROWS`` rows (counted) and joined by a shuffle beyond.

Edge cases: a text without words, or null, has the empty set and is linked with
nothing. A null doc_id is linked with nothing, its component is null and it is
kept. Rows that repeat a doc_id share its component. Ties go to the smallest
doc_id. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import pairs, textops
from quarry.llm.registry import query, table
from quarry.operators.components import connected_components
from quarry.session import stage

COORDS = 64
BRANCH = 2
SMALL = 256
BUCKETS = 1 << 18
ID_ROWS = 2_000_000
WIDTH = 5

_RNG = np.random.default_rng(7)
_XOR = _RNG.integers(0, 2**63, COORDS, dtype=np.uint64)
_MUL = _RNG.integers(0, 2**63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SIGNATURE = "doc_id bigint, n bigint, fp1 bigint, fp2 bigint, bits bigint, sig array<bigint>, sketch array<bigint>"


def trees_for(recall: float, num: int, den: int) -> int:
    """Trees so that a pair at the threshold shares a root child with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - num / den) / BRANCH))


def pairs_for(recall: float, num: int, den: int) -> int:
    """Pairs of minwise tokens so that documents at the threshold have one in common with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - (num / den) ** 2)))


def _minwise(sets: list[np.ndarray]) -> np.ndarray:
    """COORDS minwise tokens of each non-empty set."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), COORDS), dtype=np.uint64)
    for k in range(COORDS):
        out[:, k] = np.minimum.reduceat((flat ^ _XOR[k]) * _MUL[k], starts)
    return out


def _signature_batches(batches):
    for batch in batches:
        ids = batch.column("doc_id")
        for lo, hi, data, offsets in textops.slices(batch, "text"):
            sets = textops.shingle_sets(data, offsets, WIDTH)
            n = np.array([len(s) for s in sets], dtype=np.int64)
            sig = np.zeros((hi - lo, COORDS), dtype=np.uint64)
            prints = np.zeros((2, hi - lo), dtype=np.uint64)
            full = np.flatnonzero(n)
            if len(full):
                held = [sets[i] for i in full]
                sig[full] = _minwise(held)
                flat, starts = np.concatenate(held), np.cumsum(n[full]) - n[full]
                for row, salt in enumerate((0x5851F42D4C957F2D, 0x14057B7EF767814F)):
                    prints[row, full] = np.add.reduceat(textops.mix(flat ^ np.uint64(salt)), starts)
            one_bit = (textops.mix(sig) >> np.uint64(63)) << np.arange(COORDS, dtype=np.uint64)
            bits = np.bitwise_or.reduce(one_bit, axis=1)
            flat_sig = pa.array(np.ascontiguousarray(sig).view(np.int64).ravel())
            yield pa.RecordBatch.from_arrays([
                ids.slice(lo, hi - lo).cast(pa.int64()), pa.array(n), pa.array(prints[0].view(np.int64)),
                pa.array(prints[1].view(np.int64)), pa.array(bits.view(np.int64)),
                pa.ListArray.from_arrays(pa.array(np.arange(0, (hi - lo + 1) * COORDS, COORDS, dtype=np.int32)), flat_sig),
                pairs.lists([pairs.sketch(s) for s in sets]),
            ], names=["doc_id", "n", "fp1", "fp2", "bits", "sig", "sketch"])


@functools.lru_cache(maxsize=None)
def bits_apart(num: int, den: int, miss: float = 1e-9) -> int:
    """In how many of the COORDS one-bit tokens a pair at the threshold may differ, but for a chance of ``miss``."""
    p, at, left = (den - num) / den / 2, 0, 1.0
    while True:
        left -= math.comb(COORDS, at) * p ** at * (1 - p) ** (COORDS - at)
        if left < miss or at == COORDS:
            return at
        at += 1


def _near(a: str, b: str, num: int, den: int):
    """What a linked pair must pass: enough tokens left to share (of whole sets, a size filter), one-bit tokens mostly equal."""
    n, m, i, j = (F.col(x) for x in (f"{a}.n", f"{b}.n", f"{a}.pos", f"{b}.pos"))
    apart = F.bit_count(F.col(f"{a}.bits").bitwiseXOR(F.col(f"{b}.bits")))
    most = F.least(i, j) + F.least(n - i, m - j)
    return (most * (num + den) >= (n + m) * num) & (apart <= bits_apart(num, den))


def _bucket_batches(batches):
    """(bucket, m): shingles of a partition by hash bucket."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for _, _, data, offsets in textops.slices(batch, "text"):
            flat = np.concatenate(textops.shingle_sets(data, offsets, WIDTH))
            counts += np.bincount((flat & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
    full = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(counts[full])], names=["bucket", "m"])


def _prefix_batches(shared, num: int, den: int):
    def prefixes(batches):
        common = shared.value
        for batch in batches:
            for lo, hi, data, offsets in textops.slices(batch, "text"):
                n = batch.column("n").slice(lo, hi - lo).to_numpy()
                rows, tokens, places = [], [], []
                for row, s in enumerate(textops.shingle_sets(data, offsets, WIDTH)):
                    if len(s) and len(s) == n[row]:  # another text of a repeated id may have another size
                        first = np.lexsort((s, common[(s & np.uint64(BUCKETS - 1)).astype(np.int64)]))
                        first = first[:len(s) + num * len(s) // -den + 1]
                        rows.append(np.full(len(first), row)), tokens.append(s[first]), places.append(np.arange(len(first)))
                if rows:
                    at = pa.array(np.concatenate(rows) + lo)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(tokens).view(np.int64)), *(batch.column(c).take(at) for c in ("id", "n", "bits")),
                         pa.array(np.concatenate(places).astype(np.int64))], names=["node", "id", "n", "bits", "pos"])
    return prefixes


def _prefixes(ids: DataFrame, docs: DataFrame, num: int, den: int) -> DataFrame:
    """(node, id, n, bits, pos): the rarest shingles of the documents ``ids`` (id, n, bits), enough to share one with any linked one."""
    if ids.count() <= ID_ROWS:
        ids = F.broadcast(ids)
    texts = docs.withColumnRenamed("doc_id", "id").join(ids, "id").select("id", "n", "bits", "text")
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for r in texts.mapInArrow(_bucket_batches, "bucket int, m bigint").groupBy("bucket").agg(F.sum("m").alias("m")).collect():
        counts[r.bucket] = r.m  # at most BUCKETS rows
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    return texts.mapInArrow(_prefix_batches(shared, num, den), "node bigint, id bigint, n bigint, bits bigint, pos bigint")


def _token_pairs(ids: DataFrame, reps: DataFrame, first: int, count: int) -> DataFrame:
    """(node, id, n, bits, pos): a node for each of ``count`` pairs of minwise tokens, from coordinate ``first``, of the documents ``ids``."""
    sig = reps.select(F.col("doc_id").alias("id"), "n", "bits", F.slice("sig", first + 1, 2 * count).alias("sig")).join(ids, ["id", "n", "bits"])
    nodes = F.array(*[F.xxhash64(F.lit(-1 - k), F.get("sig", F.lit(2 * k)), F.get("sig", F.lit(2 * k + 1))) for k in range(count)])
    return sig.select(F.explode(nodes).alias("node"), "id", "n", "bits", F.lit(0).cast("bigint").alias("pos"))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the label of their id: the component it is in so far, else itself."""
    return rows.drop("label").join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "label", F.coalesce("label", "id"))


def _merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels after more links."""
    return connected_components(edges.union(labels.select("node", "label").where("node <> label")))


def _apart(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Pairs that no link to the same first document joins already; ``edges`` has one row for each id_b."""
    to_a = edges.select(F.col("id_b").alias("id_a"), F.col("id_a").alias("_a"))
    to_b = edges.select("id_b", F.col("id_a").alias("_b"))
    rows = pairs.join(to_a, "id_a", "left").join(to_b, "id_b", "left")
    return rows.where(F.coalesce("_a", "id_a") != F.coalesce("_b", "id_b")).select("id_a", "id_b")


def links(reps: DataFrame, docs: DataFrame, num: int, den: int, recall: float = 0.999999, small: int = SMALL) -> DataFrame:
    """(node, label) of every class representative that is linked with another.

    ``reps``: doc_id, n, bits, sig, sketch. ``docs``: doc_id, text.
    """
    missed = (1 - recall) / 2  # at the roots and one level down, each
    roots = min(trees_for(1 - missed, num, den) * BRANCH, COORDS)
    couples = pairs_for(1 - missed, num, den)
    rows = reps.select(
        F.posexplode(F.slice("sig", 1, roots)).alias("_c", "_token"), F.col("doc_id").alias("id"), "n", "bits"
    ).select(F.xxhash64("_c", "_token").alias("node"), "id", "n", "bits", F.lit(0).cast("bigint").alias("pos"), F.col("id").alias("label"))
    labels = docs.sparkSession.createDataFrame([], "node bigint, label bigint")

    sketches = reps.select(F.col("doc_id").alias("id"), "n", "bits", "sketch")

    def confirmed(candidates: DataFrame) -> DataFrame | None:
        """Those of the staged candidates that are links; None without any."""
        edges = None if candidates.isEmpty() else pairs.verified(candidates, docs, WIDTH, num, den)
        return None if edges is None or edges.isEmpty() else edges

    def verified(candidates: DataFrame) -> DataFrame | None:
        """The same, for candidates that no sketch has sifted yet."""
        return confirmed(stage(pairs.sifted(stage(candidates, "path-pairs"), sketches.select("id", "n", "sketch"), num, den), "path-pairs"))

    for level in ("roots", "pairs", "prefixes") if roots + 2 * couples <= COORDS else ("roots", "prefixes"):
        exact = level == "prefixes"
        nodes = rows.groupBy("node").agg(
            F.min(F.struct("id", "n", "bits", "pos")).alias("p"), F.min("label").alias("_lo"), F.max("label").alias("_hi")
        ).where("_lo <> _hi").select("node", "p")
        held = stage(rows.drop("label").join(nodes, "node").where(F.col("id") != F.col("p.id")), "path-nodes")
        if held.isEmpty():
            return labels
        # each document with the first one of its nodes: the smallest of them at once, others where still apart
        star = stage(held.alias("h").where(_near("h", "p", num, den)).select(F.col("p.id").alias("id_a"), F.col("id").alias("id_b")).distinct(),
                     "path-stars")
        nearest = star.groupBy("id_b").agg(F.min("id_a").alias("id_a")).select("id_a", "id_b")
        edges = verified(nearest)
        others = star.join(nearest, ["id_a", "id_b"], "left_anti")
        more = verified(others if edges is None else _apart(others, edges))
        found = [e for e in (edges, more) if e is not None]
        if found:
            labels = _merged(labels, functools.reduce(DataFrame.union, found))
        # the first document of a node has met all others; what is left to compare are its other components
        seen = stage(_labelled(held.drop("p"), labels), "path-rows")
        parts = seen.groupBy("node", "label").agg(F.count(F.lit(1)).alias("m")).groupBy("node").agg(
            F.sum("m").alias("size"), F.max(F.struct("m", "label")).alias("main"), F.count(F.lit(1)).alias("parts"))
        left = stage(seen.join(parts.where("parts > 1").drop("parts"), "node"), "path-rows")
        if left.isEmpty():
            return labels
        solved = F.lit(exact) | (F.col("size") <= small) | (F.col("size") - F.col("main.m") <= small)
        few = stage(left.where(solved).join(sketches, ["id", "n", "bits"]), "path-few")
        others = few.where(F.col("label") != F.col("main.label"))
        a, b = others.alias("a"), few.alias("b")
        few_pairs = a.join(b, (F.col("a.node") == F.col("b.node")) & (F.col("a.label") != F.col("b.label")) & _near("a", "b", num, den)
                           & pairs.may_link(F.col("a.n"), F.col("b.n"), pairs.apart("a.sketch", "b.sketch"), num, den)).select(
            F.least("a.id", "b.id").alias("id_a"), F.greatest("a.id", "b.id").alias("id_b")).distinct()
        edges = confirmed(stage(few_pairs, "path-pairs"))
        labels = labels if edges is None else _merged(labels, edges)
        many = left.where(~solved)
        if exact or many.isEmpty():
            return labels
        large = stage(many.select("id", "n", "bits").distinct(), "path-large")
        if level == "roots" and roots + 2 * couples <= COORDS:
            large = _token_pairs(large, reps, roots, couples)
        else:
            large = _prefixes(large, docs, num, den)
        rows = stage(_labelled(large, labels), "path-deeper")


def components(docs: DataFrame, num: int = 85, den: int = 100, recall: float = 0.999999, small: int = SMALL,
               text_col: str = "text", key_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    docs = docs.select(F.col(key_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    # the row number makes one row of a class its representative, also when ids repeat
    signed = stage(docs.mapInArrow(_signature_batches, SIGNATURE).withColumn("row", F.monotonically_increasing_id()),
                   "path-signatures")
    whole = signed.where("n > 0 and doc_id is not null")
    classes = whole.groupBy("n", "fp1", "fp2").agg(F.min(F.struct("doc_id", "row")).alias("first"),
                                                   F.count(F.lit(1)).alias("_m")).where("_m > 1")
    members = stage(signed.select("doc_id", "n", "fp1", "fp2", "row").join(
        classes.drop("_m"), ["n", "fp1", "fp2"], "left").select(
        "doc_id", "n", "row", F.when(F.col("doc_id").isNotNull(), F.coalesce("first.doc_id", "doc_id")).alias("rep"),
        F.coalesce("first.row", "row").alias("rep_row")), "path-members")
    others = members.where("row <> rep_row").select("row")
    reps = whole.join(others, "row", "left_anti").select("doc_id", "n", "bits", "sig", "sketch")
    found = links(reps, docs, num, den, recall, small)
    out = members.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.coalesce("label", "rep")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, num: int = 80, den: int = 100, key_col: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that a smaller doc_id of their component stands for."""
    gone = components(docs, num, den, key_col=key_col).where("not kept").select(F.col("doc_id").alias(key_col)).distinct()
    return docs.join(stage(gone, "path-gone"), key_col, "left_anti")


_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda x: x <> '') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
size AS (SELECT doc_id, len(sh) AS n FROM sets),
item AS MATERIALIZED (SELECT doc_id, unnest(sh) AS s FROM sets),
met AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM item a JOIN item b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (
  SELECT x, y FROM met JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * common >= 85 * (p.n + q.n - common)),
two AS MATERIALIZED (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id, doc_id AS r FROM size UNION SELECT reach.doc_id, two.y FROM reach JOIN two ON two.x = reach.r)
SELECT size.doc_id, CAST(n AS BIGINT) AS n_shingles, min(r) AS component_id, size.doc_id = min(r) AS kept
FROM size JOIN reach ON reach.doc_id = size.doc_id GROUP BY size.doc_id, n
"""


@query("op2_near_duplicates", _SQL)
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "documents"))
