"""Source divergence audit: a k2-tree over the group-term count matrix.

A group is a (lang, source) with a document; its row of the matrix counts the
terms (runs of letters and other non-ASCII characters, A-Z lower-cased) that at
least ``LEAST_DOCS`` documents of its lang hold. With N a row's sum and V the
lang's terms, a count gives p = 1 + floor(SCALE * (count + ALPHA) / (N + ALPHA * V)).
Part ``pair`` sums abs(p - q) over all terms for each other source of the lang;
part ``term`` ranks the ``TOP`` terms whose p is most above that of the whole lang.

1. One pass counts terms by partition, sent on whenever ``FLUSH`` entries are
   held; (lang, source, term) sums follow.
2. Terms get columns by falling count, from range partitions and their offsets;
   the dense part of the matrix so lies to the left and the empty quadrants are
   large. Sources get rows in name order.
3. The matrix is cut into blocks of ``ROWS`` groups by ``COLUMNS`` terms, the
   upper nodes of the tree. A pair of block rows and a block column is a unit of
   work, of bounded size whatever the numbers of sources and terms; blocks are
   copied to their units by an exact key, and units are dealt by hash.
4. In a unit both blocks become quadtrees of occupancy, traversed together: where
   both quadrants are all zero, every pair of groups is priced at once, columns
   times the difference of their p of zero; other quadrants split down to leaves,
   whose cells are compared for all pairs of their groups.

Null text, lang and source are empty strings. Groups without terms and langs
without a kept term (pair value 0) are returned. Ties of a value go to the
smaller item in UTF-8 order. doc_id is not used: repeated rows and ids count as
documents. An empty table gives no rows. Extra columns are ignored. Arithmetic is
in integers (products in decimals of 38 digits). Texts are taken whole, in
pieces of a megabyte, and not shuffled. A lang's sources are numbered in one
task (names alone); its terms are not.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.registry import query, table
from quarry.session import stage

LEAST_DOCS = 30
ALPHA = 5
SCALE = 1_000_000_000
TOP = 50
ROWS = 128
COLUMNS = 4096
LEAF_ROWS, LEAF_COLUMNS = 8, 64
FLUSH = 200_000
PIECE = 1 << 20
SALTS = 64

# letters stay (A-Z lower-cased), bytes of other UTF-8 characters stay, the rest are blanks
_TERM_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def count_terms(text: bytes) -> Counter:
    """Occurrences of each term of a whole UTF-8 text."""
    found, open_term = Counter(), []
    for at in range(0, len(text), PIECE):
        head, *others = text[at:at + PIECE].translate(_TERM_BYTES).split(b" ")
        open_term.append(head)
        if others:
            found[b"".join(open_term)] += 1
            open_term = [others.pop()]
            found.update(others)
    found[b"".join(open_term)] += 1
    found.pop(b"", None)
    return found


def _count_batches(batches):
    """(lang, source, term, n, docs) of a partition; a row without a term for each group."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
    held: dict[tuple, Counter] = defaultdict(Counter)
    docs: dict[tuple, Counter] = defaultdict(Counter)
    size = 0

    def sums():
        for (lang, source), counts in held.items():
            terms = [*counts]
            of = docs[lang, source]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * (len(terms) + 1), pa.string()), pa.array([source] * (len(terms) + 1), pa.string()),
                pa.array([*terms, None], pa.binary()).cast(pa.string()), pa.array([*(counts[t] for t in terms), 0], pa.int64()),
                pa.array([*(of[t] for t in terms), 0], pa.int64())], schema=schema)

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
            found = count_terms(text.as_py() or b"")
            counts = held[lang or "", source or ""]
            size -= len(counts)
            counts.update(found)
            size += len(counts) + 1
            docs[lang or "", source or ""].update(found.keys())
            if size >= FLUSH:
                yield from sums()
                held.clear()
                docs.clear()
                size = 0
    yield from sums()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of every group and term; a null term stands for the group itself."""
    rows = docs.select("lang", "source", "text").mapInArrow(
        _count_batches, "lang string, source string, term string, n bigint, docs bigint")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _with_columns(vocabulary: DataFrame) -> DataFrame:
    """``vocabulary`` (lang, term, total) with ``col``: 0 for the most frequent term of the lang, without gaps."""
    order = ["lang", F.col("total").desc(), "term"]
    ranged = stage(vocabulary.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_seq")), "term-ranges")
    firsts = ranged.groupBy("lang", "_part").agg(F.count(F.lit(1)).alias("_m"), F.min("_seq").alias("_s0"))
    before = Window.partitionBy("lang").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = firsts.select("lang", "_part", "_s0", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_o"))
    return ranged.join(offsets, ["lang", "_part"]).select(
        "lang", "term", "total", (F.col("_o") + F.col("_seq") - F.col("_s0")).alias("col"))


def smoothed(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + ALPHA) / (total + ALPHA * terms)), exact."""
    over = (count + ALPHA).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", over, (total + terms * ALPHA).cast("decimal(20,0)")) + 1


class _Block:
    """Dense p of a block's groups by its columns, zeros filled in, and its occupancy by leaf."""

    def __init__(self, cells: pa.Table, width: int):
        group, col, p = (cells.column(c).to_numpy() for c in ("row", "col", "p"))
        zero = col < 0  # one such row for each group of the block: its p of a zero count
        order = np.argsort(group[zero])
        self.groups, self.base = group[zero][order], p[zero][order]
        self.p = np.repeat(self.base[:, None], width, axis=1)
        at = np.searchsorted(self.groups, group[~zero])
        self.p[at, col[~zero]] = p[~zero]
        self.levels = [np.zeros((-(-len(self.groups) // LEAF_ROWS), -(-width // LEAF_COLUMNS)), dtype=bool)]
        self.levels[0][at // LEAF_ROWS, col[~zero] // LEAF_COLUMNS] = True
        while max(self.levels[-1].shape) > 1:
            low = self.levels[-1]
            even = np.pad(low, [(0, n % 2) for n in low.shape])
            self.levels.append(even[::2, ::2] | even[1::2, ::2] | even[::2, 1::2] | even[1::2, 1::2])

    def occupied(self, level: int, row: int, col: int) -> bool:
        if level >= len(self.levels):
            return bool(self.levels[-1][0, 0]) if row == col == 0 else False
        held = self.levels[level]
        return row < held.shape[0] and col < held.shape[1] and bool(held[row, col])


def _distances(a: _Block, b: _Block, width: int) -> np.ndarray:
    """Sum over the columns of abs(p_a - p_b) for every group of ``a`` by every group of ``b``."""
    out = np.zeros((len(a.groups), len(b.groups)), dtype=np.int64)
    todo = [(max(len(a.levels), len(b.levels)) - 1, 0, 0, 0)]  # level, quadrant row of a, of b, quadrant column
    while todo:
        level, i, j, c = todo.pop()
        step, wide = LEAF_ROWS << level, LEAF_COLUMNS << level
        ra, rb = slice(i * step, (i + 1) * step), slice(j * step, (j + 1) * step)
        cols = slice(c * wide, min((c + 1) * wide, width))
        if i * step >= len(a.groups) or j * step >= len(b.groups) or cols.start >= width:
            continue
        if not a.occupied(level, i, c) and not b.occupied(level, j, c):
            out[ra, rb] += (cols.stop - cols.start) * np.abs(a.base[ra, None] - b.base[None, rb])
        elif level:
            todo += [(level - 1, 2 * i + x, 2 * j + y, 2 * c + z) for x in (0, 1) for y in (0, 1) for z in (0, 1)]
        else:
            out[ra, rb] += np.abs(a.p[ra, None, cols] - b.p[None, rb, cols]).sum(axis=2)
    return out


def _price(left: pa.Table, right: pa.Table) -> pa.Table:
    """(lang, a, b, value) of the group pairs of a unit, over its columns."""
    width, lang = pc.max(left.column("width")).as_py(), left.column("lang")[0].as_py()
    a, b = _Block(left, width), _Block(right, width)
    value = _distances(a, b, width)
    x, y = np.meshgrid(a.groups, b.groups, indexing="ij")
    apart = (x < y).ravel()  # each pair once: in a unit of one block with itself, too
    return pa.table({"lang": pa.array([lang] * int(apart.sum()), pa.string()), "a": x.ravel()[apart], "b": y.ravel()[apart],
                     "value": value.ravel()[apart]})


def pair_values(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value): the divergence of each two groups a < b of a lang.

    ``cells``: lang, row, col, p of the non-zero cells. ``groups``: lang, row, zero (p of a zero count), terms, sources (of the lang).
    """
    blocks = F.floor(F.col("row") / ROWS).cast("int")
    strips = F.greatest(F.ceil(F.col("terms") / COLUMNS).cast("int"), F.lit(1))
    marks = groups.where("sources > 1").select("*", F.explode(F.sequence(F.lit(0), strips - 1)).alias("strip")).select(
        "lang", "row", F.lit(-1).alias("col"), F.coalesce("zero", F.lit(0).cast("bigint")).alias("p"), "strip",
        F.least(F.col("terms") - F.col("strip") * COLUMNS, F.lit(COLUMNS)).cast("int").alias("width"), "sources")
    held = cells.where("sources > 1").select(
        "lang", "row", (F.col("col") % COLUMNS).cast("int").alias("col"), "p", F.floor(F.col("col") / COLUMNS).cast("int").alias("strip"),
        F.lit(None).cast("int").alias("width"), "sources")
    rows = stage(marks.unionByName(held).withColumn("block", blocks).withColumn(
        "last", F.floor((F.col("sources") - 1) / ROWS).cast("int")).drop("sources"), "k2-blocks")
    unit = ["lang", "strip", "block_a", "block_b"]
    a = rows.select("lang", "strip", F.col("block").alias("block_a"), F.explode(F.sequence("block", "last")).alias("block_b"), "row", "col", "p", "width")
    b = rows.select("lang", "strip", F.explode(F.sequence(F.lit(0), F.col("block"))).alias("block_a"), F.col("block").alias("block_b"),
                    "row", "col", "p", "width")
    priced = a.groupBy(*unit).cogroup(b.groupBy(*unit)).applyInArrow(_price, "lang string, a bigint, b bigint, value bigint")
    return priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, lang_col: str = "lang", source_col: str = "source",
          text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank) of every group of ``docs``."""
    counts = stage(term_counts(docs.select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))),
                   "term-counts")
    vocabulary = counts.where("term is not null").groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).drop("docs")
    vocabulary = stage(_with_columns(vocabulary), "term-columns")
    langs = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_n"))

    in_lang = Window.partitionBy("lang")
    names = counts.where("term is null").select("lang", "source")
    cells = stage(counts.where("term is not null").join(vocabulary, ["lang", "term"]).select(
        "lang", "source", "term", "col", "n", "total"), "term-cells")
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = names.select("*", (F.row_number().over(in_lang.orderBy("source")) - 1).cast("bigint").alias("row"),
                          F.count(F.lit(1)).over(in_lang).alias("sources"))
    groups = groups.join(langs, "lang", "left").join(sums, ["lang", "source"], "left").select(
        "lang", "source", "row", "sources", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("group_n", F.lit(0)).alias("group_n"), "lang_n")
    groups = stage(groups.withColumn("zero", F.when(F.col("terms") > 0, smoothed(F.lit(0), F.col("group_n"), F.col("terms")))), "groups")

    # a group holds most rows at will: its few numbers come to the cells by salted keys where Spark does not broadcast them
    salted = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    priced = cells.withColumn("_salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")).join(
        salted, ["lang", "source", "_salt"]).select(
        "lang", "source", "term", "row", "col", "sources", smoothed(F.col("n"), F.col("group_n"), F.col("terms")).alias("p"),
        smoothed(F.col("total"), F.col("lang_n"), F.col("terms")).alias("q"))
    priced = stage(priced, "priced-cells")

    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    above = priced.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         (F.col("p") - F.col("q")).alias("value"))
    term_part = above.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    values = stage(pair_values(priced, groups), "pair-values")
    both = values.union(values.select("lang", F.col("b"), F.col("a"), "value"))
    of = groups.select("lang", F.col("row").alias("a"), "source")
    other = groups.select("lang", F.col("row").alias("b"), F.col("source").alias("item"))
    pair_part = both.join(of, ["lang", "a"]).join(other, ["lang", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return term_part.unionByName(pair_part.withColumn("rank", F.row_number().over(best)))


_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
v AS MATERIALIZED (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
l AS (SELECT lang, count(*) AS vn, sum(total) AS ln FROM v GROUP BY lang),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM w JOIN v USING (lang, term) GROUP BY lang, source, term),
gn AS (SELECT lang, source, sum(n) AS gn FROM c GROUP BY lang, source),
p AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (coalesce(gn, 0) + 5 * vn) AS p,
    1 + (1000000000::HUGEINT * (total + 5)) // (ln + 5 * vn) AS q
  FROM g JOIN v USING (lang) JOIN l USING (lang) LEFT JOIN gn USING (lang, source) LEFT JOIN c USING (lang, source, term)),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY 1, 2, 3),
every AS (SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@query("op12_source_divergence", _SQL)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))
