"""Registered queries: JSONL scans (round trip through files Spark writes from the
fixtures), ingest, shard listing/selection/statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as TX
from quarry.operators import instructions as INS
from quarry.operators import sampling as SM
from quarry.plans import sql as S
from quarry.plans.registry import docs_with_edges, query, table
from quarry.session import staging_dir
from quarry.sources import ingest as IG
from quarry.sources import jsonl as J
from quarry.sources import sinks

GLOB = "*.txt"  # Spark's text writer names its files part-*.txt


def _stage_lines(lines, name):
    return J.write_lines(lines.where(F.col("value").isNotNull()), staging_dir(lines.sparkSession, name))


def _doc_lines(spark, sf_dir):
    """documents as JSONL: one object per doc, plus a malformed line for every 'es'
    doc and a blank line for every 'de' doc."""
    docs = table(spark, sf_dir, "documents")
    js = F.to_json(F.struct("text", "source", "doc_id"))
    value = F.explode(F.array(js, F.when(F.col("lang") == "es", F.concat(F.lit("{"), js)),
                              F.when(F.col("lang") == "de", F.lit(""))))
    return docs.select(value.alias("value"))


@query("scan_jsonl_lenient", "SELECT doc_id, sha1(text) AS text_sha1, source FROM documents")
def q_scan_lenient(spark, sf_dir):
    path = _stage_lines(_doc_lines(spark, sf_dir), "jsonl-docs")
    rows = J.scan_jsonl_lenient(spark, path, J.TEXT_RECORD, GLOB)
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), TX.text_sha1(F.col("text")).alias("text_sha1"),
                       "source")


@query("scan_malformed", "SELECT count(*) + count_if(lang = 'es') AS n_lines, count_if(lang = 'es') AS n_malformed "
       "FROM documents")
def q_scan_malformed(spark, sf_dir):
    path = _stage_lines(_doc_lines(spark, sf_dir), "jsonl-docs")
    return J.count_malformed(spark, path, J.TEXT_RECORD, GLOB)


@query("load_text", "SELECT doc_id, sha1(text) AS text_sha1, CASE lang WHEN 'de' THEN 'unknown' WHEN 'es' THEN NULL "
       "ELSE source END AS source, n_chars, CAST(NULL AS DOUBLE) AS lang_score FROM documents WHERE lang <> 'fr'")
def q_load_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    lang = F.col("lang")
    value = (
        F.when(lang == "es", F.to_json(F.struct("text", F.lit(None).cast("string").alias("source"), "doc_id", "n_chars"),
                                       {"ignoreNullFields": "false"}))
        .when(lang == "de", F.to_json(F.struct("text", "doc_id", "n_chars")))
        .when(lang == "fr", F.to_json(F.struct("source", "doc_id", "n_chars")))
        .otherwise(F.to_json(F.struct("text", "source", "doc_id", "n_chars")))
    )
    path = _stage_lines(docs.select(value.alias("value")), "jsonl-text")
    recs = J.load_text(spark, path, GLOB)
    return recs.select(F.col("doc_id").cast("bigint").alias("doc_id"), TX.text_sha1(F.col("text")).alias("text_sha1"),
                       "source", "n_chars", "lang_score")


_INSTR_SQL = """WITH u AS (SELECT * FROM conversations WHERE role = 'user'),
a AS (SELECT * FROM conversations WHERE role = 'assistant')
SELECT sha1(u.text) AS prompt_sha1, sha1(a.text) AS response_sha1, CAST(2000 + u.turn AS INTEGER) AS year,
  CASE WHEN u.turn = 0 THEN 'podstawowa' ELSE 'rozszerzona' END AS level, 'cke' AS source
FROM u JOIN a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1"""


@query("load_instructions", _INSTR_SQL)
def q_load_instructions(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    users = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    bots = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    rows = users.join(bots, on=["conv_id", "turn"], how="left")  # unanswered prompts lack 'response'
    value = F.to_json(F.struct(
        "prompt", "response", (F.lit(2000) + F.col("turn")).cast("int").alias("year"),
        F.when(F.col("turn") == 0, F.lit("podstawowa")).otherwise(F.lit("rozszerzona")).alias("level")))
    path = _stage_lines(rows.select(value.alias("value")), "jsonl-instr")
    recs = J.load_instructions(spark, path, GLOB)
    return recs.select(TX.text_sha1(F.col("prompt")).alias("prompt_sha1"),
                       TX.text_sha1(F.col("response")).alias("response_sha1"), "year", "level", "source")


@query("eval_text_scan", f"WITH src AS ({S.src_with_edges()}) SELECT doc_id, sha1(text) AS text_sha1 FROM src "
       "WHERE coalesce(text, '') <> ''")
def q_eval_text_scan(spark, sf_dir):
    lines = docs_with_edges(spark, sf_dir).select(F.to_json(F.struct("text", "doc_id")).alias("value"))
    path = _stage_lines(lines, "jsonl-eval")
    rows = J.eval_text_scan(spark, path, "text", GLOB)
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), TX.text_sha1(F.col("text")).alias("text_sha1"))


# ---------------------------------------------------------------- ingest

SHARD_RE = "^[a-z]+://[^/]+/([a-z]{2})/"
TITLE_RE = "<title>(.*?)</title>"


def _web_shards(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    shard = F.coalesce(F.nullif(F.regexp_extract("url", SHARD_RE, 1), F.lit("")), F.lit("misc"))
    return IG.ingest_shards(pages, "web", shard, F.col("html"), meta_url=F.col("url"), meta_id=F.col("page_id"),
                            meta_title=F.regexp_extract("html", TITLE_RE, 1))


_WEB_SQL = (f"SELECT html AS text, 'web/' || coalesce(nullif(regexp_extract(url, '{SHARD_RE}', 1), ''), 'misc') AS source, "
            f"coalesce(nullif(url, ''), nullif(CAST(page_id AS VARCHAR), ''), nullif(regexp_extract(html, '{TITLE_RE}', 1), '')) "
            f"AS doc_id FROM pages WHERE coalesce(html, '') <> ''")


@query("ingest_dataset", "SELECT sha1(text) AS text_sha1, 'docs' AS source FROM documents WHERE coalesce(text, '') <> ''")
def q_ingest_dataset(spark, sf_dir):
    rows = IG.ingest_dataset(table(spark, sf_dir, "documents"), "docs", "text")
    return rows.select(TX.text_sha1(F.col("text")).alias("text_sha1"), "source")


@query("ingest_shards", f"SELECT sha1(text) AS text_sha1, source, doc_id FROM ({_WEB_SQL})")
def q_ingest_shards(spark, sf_dir):
    return _web_shards(spark, sf_dir).select(TX.text_sha1(F.col("text")).alias("text_sha1"), "source", "doc_id")


@query("ingest_shard_counts", f"SELECT source, count(*) AS n_kept FROM ({_WEB_SQL}) GROUP BY source")
def q_ingest_shard_counts(spark, sf_dir):
    return IG.shard_counts(_web_shards(spark, sf_dir))


@query("ingest_union", f"SELECT sha1(text) AS text_sha1, source, doc_id FROM ({_WEB_SQL}) UNION ALL "
       "SELECT sha1(text), 'docs', NULL FROM documents WHERE coalesce(text, '') <> ''")
def q_ingest_union(spark, sf_dir):
    specs = [
        IG.SourceSpec("docs", "dataset", lambda: IG.ingest_dataset(table(spark, sf_dir, "documents"), "docs")),
        IG.SourceSpec("web", "shards", lambda: _web_shards(spark, sf_dir)),
        IG.SourceSpec("qa", "instruction",
                      lambda: INS.conversation_pairs(table(spark, sf_dir, "conversations"))),
    ]
    corpus, _instructions = IG.ingest_union(specs)
    return corpus.select(TX.text_sha1(F.col("text")).alias("text_sha1"), "source", "doc_id")


# ---------------------------------------------------------------- shards

REQUESTED = ["src1", "src3", "src5"]
REQUESTED_WITH_UNKNOWN = ["src1", "src3", "src42", "web9"]


@query("shard_stats", "SELECT source, count(*) AS n_docs, sum(length(text)) AS n_chars FROM documents GROUP BY source")
def q_shard_stats(spark, sf_dir):
    return IG.shard_stats(table(spark, sf_dir, "documents"))


@query("list_shards", "SELECT DISTINCT source FROM documents")
def q_list_shards(spark, sf_dir):
    return IG.list_shards(table(spark, sf_dir, "documents"))


@query("select_shards", "SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src3', 'src5')")
def q_select_shards(spark, sf_dir):
    return IG.select_shards(table(spark, sf_dir, "documents"), REQUESTED).select("doc_id", "source")


@query("missing_shards", "SELECT source FROM (VALUES ('src1'), ('src3'), ('src42'), ('web9')) r(source) "
       "EXCEPT SELECT source FROM documents")
def q_missing_shards(spark, sf_dir):
    return IG.missing_shards(spark, table(spark, sf_dir, "documents"), REQUESTED_WITH_UNKNOWN)


# ---------------------------------------------------------------- end to end over files

def _prepare_run(spark, sf_dir):
    from quarry.plans import prepare as P
    from quarry.plans.options import PrepareOptions

    docs = table(spark, sf_dir, "documents")
    lines = docs.select(F.to_json(F.struct("text", "source")).alias("value"))
    raw = _stage_lines(lines, "raw-corpus")
    out = staging_dir(spark, "prepared")
    stats = P.run(spark, raw, out, PrepareOptions(shard_size=100), glob=GLOB)
    return stats, out


_RUN_CTE = S.classified(src="SELECT doc_id, text, lang, source FROM documents")


@query("prepare_run", f"WITH {_RUN_CTE} SELECT count(*) AS seen, count_if(reason = 'kept') AS kept, "
       + ", ".join(f"count_if(reason = '{r}') AS dropped_{r}" for r in ("empty", "short", "long", "lang", "dup"))
       + " FROM cls")
def q_prepare_run(spark, sf_dir):
    """documents written as JSONL files, prepared end to end (scan -> normalize -> filters ->
    dedup -> split -> shards -> write); returns the run's counters."""
    stats, _ = _prepare_run(spark, sf_dir)
    return stats


@query("prepare_run_output", f"WITH {_RUN_CTE} SELECT {S.split_case('doc_hash', 42, 0.05)} AS split, "
       "count(*) AS n_rows, count(DISTINCT source) AS n_sources FROM cls WHERE reason = 'kept' GROUP BY ALL")
def q_prepare_run_output(spark, sf_dir):
    """Rows per split read back from the written train/val shards."""
    _, out = _prepare_run(spark, sf_dir)
    back = sinks.read_shards(spark, out)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("source").alias("n_sources"))


@query("shards_input_order", f"""WITH s AS (SELECT doc_id, {S.split_case('doc_id', 42, 0.2)} AS split FROM documents),
r AS (SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS rank FROM s)
SELECT doc_id, split, rank, rank // 100 AS shard FROM r""")
def q_shards_input_order(spark, sf_dir):
    """Shards of 100 rows in path and line order of JSONL files (which hold the documents by doc_id)."""
    docs = table(spark, sf_dir, "documents").repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id")
    path = J.write_lines(docs.select(F.to_json(F.struct("text", "source", "doc_id")).alias("value")), staging_dir(spark, "jsonl-ordered"))
    rows = J.scan_jsonl_lenient(spark, path, J.TEXT_RECORD, GLOB).select("order_key", F.col("doc_id").cast("bigint").alias("doc_id"))
    split = SM.split_train_val(rows, "doc_id", 42, 0.2)
    return SM.assign_shards_in_order(split, ["order_key"], 100).select("doc_id", "split", "rank", "shard")


_LINED = """WITH l AS (SELECT source, doc_id, lang, unnest(CASE lang WHEN 'es' THEN ['doc', 'bad'] WHEN 'de' THEN ['doc', 'blank'] ELSE ['doc'] END) AS kind,
  unnest(CASE WHEN lang IN ('es', 'de') THEN [1, 2] ELSE [1] END) AS place FROM documents),
n AS (SELECT source, kind, row_number() OVER (PARTITION BY source ORDER BY doc_id, place) AS line_no FROM l)"""


@query("malformed_line_numbers", _LINED + " SELECT source, line_no FROM n WHERE kind = 'bad'")
def q_malformed_line_numbers(spark, sf_dir):
    """Line numbers of malformed lines in one JSONL file for each source."""
    docs = table(spark, sf_dir, "documents").repartition("source").sortWithinPartitions("source", "doc_id")
    js = F.to_json(F.struct("text", "doc_id"))
    value = F.array_compact(F.array(js, F.when(F.col("lang") == "es", F.concat(F.lit("{"), js)), F.when(F.col("lang") == "de", F.lit(""))))
    path = J.write_lines(docs.select(F.col("source").alias("folder"), F.explode(value).alias("value")),
                         staging_dir(spark, "jsonl-lines"), ["folder"])
    return J.malformed_lines(spark, path, J.TEXT_RECORD, GLOB).select(
        F.regexp_extract("file_path", "folder=([^/]*)/", 1).alias("source"), "line_no")


@query("ingest_write", "SELECT doc_id, 'corpus/' || source AS source, source AS shard, sha1(text) AS text_sha1 FROM documents "
       "WHERE source IN ('src1', 'src3', 'src5') AND coalesce(text, '') <> ''")
def q_ingest_write(spark, sf_dir):
    """Documents ingested shard by shard, written to a folder for each, rescanned by requested shards."""
    docs = table(spark, sf_dir, "documents")
    rows = IG.ingest_shards(docs, "corpus", F.col("source"), F.col("text"), meta_id=F.col("doc_id").cast("string"))
    path = sinks.write_corpus_rows(rows, staging_dir(spark, "ingested"), partition_col="shard")
    back = IG.scan_ingested(spark, path, ["src1", "src3", "src5"])
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "shard", TX.text_sha1(F.col("text")).alias("text_sha1"))
