"""Benchmark decontamination: size-partitioned MinHash containment search.

Items and documents are sets of 5-word shingles over lower-cased words (runs of
other characters than 0x20 and 0x09-0x0D). A document contains an item when it
holds at least ``num / den`` of the item's distinct shingles.

Items are partitioned by size (powers of two). Each partition has one sketch
length, from its upper size bound u: ``u - ceil(t u) + 1`` shingles, the first
in the order (items that hold the shingle, hash). A document without any of them
lacks more of the item than the threshold allows, so the search loses nothing,
whatever the document's length; the order keeps shingles that many items share
out of the sketches. Documents stream their shingle hashes past the sketches;
the (document, item) pairs met are verified on the shingles themselves.

With one to four words the whole sequence is the only shingle, of items and
documents alike. Items and documents without words, or null, match nothing. A
null doc_id or item_id is never reported. Items with the same shingles are one,
reported by their smallest item_id; repeated documents or ids are reported once.
Empty tables give no rows. Extra columns are ignored.

The sketches are broadcast up to ``SKETCH_ROWS`` rows (counted; 16 bytes each);
more are joined by a shuffle on the hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.registry import query, table
from quarry.session import stage

SKETCH_ROWS = 2_000_000
WIDTH = 5


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[^\x20\x09-\x0D]+"), 0)


def _windows(w: Column, build) -> Column:
    """``build`` on the words of each window; the whole sequence when it is shorter than a window.

    ``w`` has to be a plain column: an expression would be evaluated again for every window.
    """
    n = F.size(w)
    return F.when(n >= WIDTH, F.transform(F.sequence(F.lit(0), n - WIDTH), lambda i: build(*[w[i + k] for k in range(WIDTH)]))
                  ).when(n == 4, F.array(build(*[w[k] for k in range(4)]))
                  ).when(n == 3, F.array(build(*[w[k] for k in range(3)]))
                  ).when(n == 2, F.array(build(*[w[k] for k in range(2)]))
                  ).when(n == 1, F.array(build(w[0])))


def hashes(w: Column) -> Column:
    return _windows(w, F.xxhash64)


def shingles(w: Column) -> Column:
    return F.array_distinct(_windows(w, lambda *p: F.concat_ws(" ", *p)))


def sketches(items: DataFrame, num: int, den: int) -> DataFrame:
    """(hash, item): the sketch of every item (item_id, w)."""
    held = items.select("item_id", F.explode(F.array_distinct(hashes(F.col("w")))).alias("hash"))
    shared = held.groupBy("hash").agg(F.count(F.lit(1)).alias("items"))
    ordered = held.join(shared, "hash").groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("items", "hash"))).alias("s"))
    upper = F.pow(F.lit(2.0), F.floor(F.log2(F.size("s"))) + 1).cast("int") - 1  # of the item's size partition
    length = upper - F.ceil(upper * num / den).cast("int") + 1
    return ordered.select("item_id", F.explode(F.slice("s", F.lit(1), length)).alias("x")).select(
        F.col("x.hash").alias("hash"), "item_id")


def search(docs: DataFrame, bench: DataFrame, num: int = 80, den: int = 100, text_col: str = "text",
           key_col: str = "doc_id", item_col: str = "item_id", sketch_rows: int = SKETCH_ROWS) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) for every document that contains an item."""
    read = docs.select(F.col(key_col).alias("doc_id"), F.col(text_col).alias("text")).where(
        "doc_id is not null and text is not null")
    items = stage(bench.select(F.col(item_col).alias("item_id"), words(F.col("text")).alias("w")).where(
        "item_id is not null and size(w) > 0").groupBy(F.sort_array(F.array_distinct(hashes(F.col("w")))).alias("set")).agg(
        F.min(F.struct("item_id", "w")).alias("f")).select("f.*"), "bench-items")
    sketch = stage(sketches(items, num, den), "bench-sketches")
    if sketch.count() <= sketch_rows:
        sketch = F.broadcast(sketch)
    # the outer form: for the inner one Spark would add a filter that takes words and hashes once more
    streamed = read.select("doc_id", words(F.col("text")).alias("w")).select(
        "doc_id", F.explode_outer(hashes(F.col("w"))).alias("hash"))
    pairs = stage(streamed.join(sketch, "hash").select("doc_id", "item_id").distinct(), "bench-pairs")
    texts = read.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi").distinct()
    texts = texts.select("doc_id", words(F.col("text")).alias("w")).select("doc_id", shingles(F.col("w")).alias("in_doc"))
    sets = items.select("item_id", shingles(F.col("w")).alias("in_item"))
    met = pairs.join(sets, "item_id").join(texts, "doc_id").select(
        "doc_id", "item_id", F.size("in_item").cast("bigint").alias("n_item"),
        F.size(F.array_intersect("in_item", "in_doc")).cast("bigint").alias("n_shared"))
    met = met.where(F.col("n_shared") * den >= F.col("n_item") * num)
    return met.groupBy("doc_id", "item_id", "n_item").agg(F.max("n_shared").alias("n_shared")).withColumn(
        "containment", F.col("n_shared") / F.col("n_item"))


def keep_clean(docs: DataFrame, bench: DataFrame, num: int = 80, den: int = 100, key_col: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that contain an item."""
    gone = stage(search(docs, bench, num, den, key_col=key_col).select(F.col("doc_id").alias(key_col)).distinct(), "bench-gone")
    return docs.join(gone, key_col, "left_anti")


_WORDS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _set(key: str, source: str) -> str:
    return f"""(SELECT {key}, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END) AS s
  FROM (SELECT {key}, {_WORDS} AS ws FROM {source}))"""


_SQL = f"""
WITH item AS MATERIALIZED {_set("item_id", "benchmark")},
doc AS MATERIALIZED {_set("doc_id", "documents")},
size AS (SELECT item_id, count(*) AS n_item, md5(string_agg(s, chr(10) ORDER BY s)) AS same FROM item GROUP BY item_id),
first AS (SELECT min(item_id) AS item_id, any_value(n_item) AS n_item FROM size GROUP BY same),
met AS (SELECT doc_id, item_id, count(*) AS n_shared FROM item JOIN doc USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM met JOIN first USING (item_id) WHERE 100 * n_shared >= 80 * n_item
"""


@query("op8_benchmark_decontamination", _SQL)
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
