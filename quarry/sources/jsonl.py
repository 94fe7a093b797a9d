"""JSONL scans.

Lines are read with the text source. Each is wrapped in brackets and parsed as an
array of records whose scalar fields are all strings: a line is *malformed* when
that does not give exactly one object (no JSON, arrays, scalars, single quotes,
text after the object, two objects) or when its bytes are not valid UTF-8. Field
values are cast afterwards, so a value of another type is null instead of making
the line malformed. Blank lines are skipped. Lines have no length limit.

Order key: ``struct(path components, file_block_start, monotonically_increasing_id())``
reproduces "files sorted by path, then line order" without a global sort: path
components compare like Python path objects, and inside one file split the id
increases with the line number. Note: Spark skips files whose name starts with
'_' or '.', which a plain recursive glob would read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import NOT_WS
from quarry.session import is_directory

GLOB = "*.{json,jsonl}"
PARSER = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "maxStringLen": "2147483647"}

TEXT_RECORD = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("doc_id", T.StringType()),
    T.StructField("lang_score", T.DoubleType()),
    T.StructField("n_chars", T.LongType()),
])

INSTRUCTION_RECORD = T.StructType([
    T.StructField("prompt", T.StringType()),
    T.StructField("response", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("level", T.StringType()),
    T.StructField("source", T.StringType()),
])

MCQA_RECORD = T.StructType([
    T.StructField("question", T.StringType()),
    T.StructField("choices", T.ArrayType(T.StringType())),
    T.StructField("answer_index", T.IntegerType()),
])


def read_lines(spark: SparkSession, paths: str | Iterable[str], glob: str = GLOB,
               recursive: bool = True) -> DataFrame:
    """Raw lines with file path and order key: (value, file_path, order_key).

    ``glob`` selects files within folders; a file that is named is read whatever its name.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    folders = [p for p in paths if is_directory(spark, p)]
    files = [p for p in paths if p not in folders]
    reader = spark.read.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    found = ([reader.text(folders)] if folders else []) + ([spark.read.text(files)] if files else [])
    order_key = F.struct(
        F.split(F.col("_metadata.file_path"), "/").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    found = [x.select("value", F.col("_metadata.file_path").alias("file_path"), order_key.alias("order_key")) for x in found]
    return functools.reduce(DataFrame.unionAll, found)


def _field(name: str, kind: T.DataType) -> Column:
    """A parsed field as its type; null where the value has another one."""
    raw = F.col(f"_j.`{name}`")
    if isinstance(kind, (T.StringType, T.ArrayType)):
        return raw.alias(name)
    if isinstance(kind, (T.IntegerType, T.LongType)):  # 12.0 is the number 12
        return F.coalesce(raw.try_cast(kind), raw.try_cast("double").try_cast(kind)).alias(name)
    return raw.try_cast(kind).alias(name)


def parse(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Parse non-blank lines: schema fields + ``_keys`` (top-level keys) + ``_malformed``."""
    record = T.StructType([T.StructField(f.name, f.dataType if isinstance(f.dataType, T.ArrayType) else T.StringType())
                           for f in schema.fields])
    nonblank = lines.where(F.col("value").rlike(NOT_WS))
    wrapped = F.concat(F.lit("["), F.col("value"), F.lit("]"))
    parsed = nonblank.withColumn("_a", F.from_json(wrapped, T.ArrayType(record), PARSER))
    parsed = parsed.withColumn("_j", F.get("_a", F.lit(0)))
    one = F.coalesce(F.size("_a") == 1, F.lit(False)) & F.col("_j").isNotNull() & F.is_valid_utf8(F.col("value"))
    return parsed.select(
        *[c for c in lines.columns if c != "value"],
        *[_field(f.name, f.dataType) for f in schema.fields],
        F.json_object_keys("value").alias("_keys"),
        (~one).alias("_malformed"),
    )


def has_key(name: str) -> Column:
    """Key presence. ``json_object_keys`` is null for a few parseable lines (bare NaN):
    fall back to 'value not null' there."""
    return F.coalesce(F.array_contains(F.col("_keys"), name), F.col(name).isNotNull())


def default_if_missing(name: str, default: str) -> Column:
    """``row.get(name, default)``: default only when the key is absent; explicit null stays null."""
    return F.when(has_key(name), F.col(name)).otherwise(F.lit(default)).alias(name)


def scan_jsonl_lenient(spark: SparkSession, paths, schema: T.StructType, glob: str = GLOB) -> DataFrame:
    """Every well-formed JSON object line under ``paths``; blank and malformed lines are dropped."""
    return parse(read_lines(spark, paths, glob), schema).where(~F.col("_malformed"))


def count_malformed(spark: SparkSession, paths, schema: T.StructType, glob: str = GLOB) -> DataFrame:
    """One row: n_lines (non-blank), n_malformed."""
    p = parse(read_lines(spark, paths, glob), schema)
    return p.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("_malformed")).alias("n_malformed"))


def with_line_numbers(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """``rows`` (with file_path, order_key) of the scan ``lines`` with ``line_no``, the 1-based number in the file.

    A file is read in splits, and a split knows its first byte but not its first line. So the lines of each split are counted
    (one narrow row for each split), summed over the splits before, and joined to the rows: a number does not depend on how
    the file was cut.
    """
    block = F.col("order_key.block")
    counts = lines.groupBy("file_path", block.alias("_block")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("order_key.line").alias("_first"))
    before = Window.partitionBy("file_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # splits of one file
    firsts = counts.select("file_path", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.withColumn("_block", block).join(firsts, ["file_path", "_block"]).withColumn(
        "line_no", F.col("_before") + F.col("order_key.line") - F.col("_first") + 1).drop("_block", "_before", "_first")


def malformed_lines(spark: SparkSession, paths, schema: T.StructType, glob: str = GLOB) -> DataFrame:
    """(file_path, line_no) of every malformed line."""
    lines = read_lines(spark, paths, glob)
    bad = parse(lines, schema).where("_malformed").select("file_path", "order_key")
    return with_line_numbers(bad, lines.select("file_path", "order_key")).select("file_path", "line_no")


def scan_jsonl_strict(spark: SparkSession, paths, schema: T.StructType, glob: str = GLOB) -> DataFrame:
    """As the lenient scan, but raises ``malformed JSON line in <path>:<line>`` for the first malformed line.

    The lines are checked first, in a pass of their own; rows read later are checked again (the files may have changed).
    """
    first = malformed_lines(spark, paths, schema, glob).agg(F.min(F.struct("file_path", "line_no")).alias("at")).first().at
    if first:
        raise ValueError(f"malformed JSON line in {first.file_path}:{first.line_no}")
    p = parse(read_lines(spark, paths, glob), schema)
    check = F.when(F.col("_malformed"), F.raise_error(F.concat(F.lit("malformed JSON line in "), F.col("file_path"))))
    return p.where(check.isNull())


def load_text(spark: SparkSession, paths, glob: str = GLOB, strict: bool = True) -> DataFrame:
    """Typed text records: rows without a 'text' key are dropped; source defaults to 'unknown'."""
    scan = scan_jsonl_strict if strict else scan_jsonl_lenient
    rows = scan(spark, paths, TEXT_RECORD, glob).where(has_key("text"))
    return rows.select(
        "order_key", "text", default_if_missing("source", "unknown"), "doc_id", "lang_score", "n_chars"
    )


def load_instructions(spark: SparkSession, paths, glob: str = GLOB, strict: bool = True,
                      default_source: str = "cke") -> DataFrame:
    """Instruction records: need both 'prompt' and 'response' keys; source defaults to the exam slice name."""
    scan = scan_jsonl_strict if strict else scan_jsonl_lenient
    rows = scan(spark, paths, INSTRUCTION_RECORD, glob).where(has_key("prompt") & has_key("response"))
    return rows.select("order_key", "prompt", "response", "year", "level", default_if_missing("source", default_source))


def eval_text_scan(spark: SparkSession, paths, text_field: str = "text", glob: str = GLOB) -> DataFrame:
    """Held-out text for scoring: keep truthy text (not stripped: whitespace-only is kept)."""
    schema = T.StructType([T.StructField(text_field, T.StringType()), T.StructField("doc_id", T.StringType())])
    rows = scan_jsonl_strict(spark, paths, schema, glob)
    return rows.where(F.coalesce(F.col(text_field), F.lit("")) != "").select(
        "order_key", F.col(text_field).alias("text"), "doc_id")


def load_mcqa(spark: SparkSession, paths, glob: str = GLOB) -> DataFrame:
    """Multiple-choice items (order_key, question, choices, answer_index); an item without all three fails the job."""
    rows = scan_jsonl_strict(spark, paths, MCQA_RECORD, glob)
    whole = F.col("question").isNotNull() & (F.size("choices") > 0) & F.col("answer_index").isNotNull()
    bad = F.raise_error(F.concat(F.lit("incomplete multiple-choice item in "), F.col("file_path")))
    return rows.where(F.when(~F.coalesce(whole, F.lit(False)), bad).isNull()).select(
        "order_key", "question", "choices", "answer_index")


def write_lines(lines: DataFrame, path: str, partition_cols: list[str] | None = None) -> str:
    """Write a single string column ``value`` as text files (one JSON line per row)."""
    w = lines.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.text(path)
    return path
