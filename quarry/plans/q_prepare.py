"""Registered queries over the text fixtures: preparation stage.

Each query takes (spark, sf_dir) and reads the whole fixture tables under
``sf_dir`` (plus, for the preparation queries, a handful of edge rows unioned
on top). Column names are identical between a query and its oracle SQL.
"""

from __future__ import annotations

import codecs

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import text as TX
from quarry.operators import dedup, filters
from quarry.operators.plugins import Plugin
from quarry.plans import prepare as P
from quarry.plans import sql as S
from quarry.plans.options import PrepareOptions
from quarry.plans.registry import LANG_OPTS, docs_with_edges, query, table
from quarry.session import staging_dir
from quarry.sources import jsonl


# ---------------------------------------------------------------- preparation


@query("prepare_stats", f"WITH {S.classified()} SELECT count(*) AS seen, "
       + ", ".join(["count_if(reason = 'kept') AS kept"]
                   + [f"count_if(reason = '{r}') AS dropped_{r}" for r in filters.REASONS])
       + " FROM cls")
def q_prepare_stats(spark, sf_dir):
    return P.quick_stats(docs_with_edges(spark, sf_dir), PrepareOptions())


@query("prepare_stats_lang", f"WITH {S.classified(lang='en')} SELECT count(*) AS seen, "
       + ", ".join(["count_if(reason = 'kept') AS kept"]
                   + [f"count_if(reason = '{r}') AS dropped_{r}" for r in filters.REASONS])
       + " FROM cls")
def q_prepare_stats_lang(spark, sf_dir):
    return P.stats(P.classify(docs_with_edges(spark, sf_dir), LANG_OPTS))  # row-level path, same counters


@query("drop_reason", f"WITH {S.classified(lang='en')} SELECT doc_id, reason FROM cls")
def q_drop_reason(spark, sf_dir):
    return P.classify(docs_with_edges(spark, sf_dir), LANG_OPTS).select("doc_id", "reason")


def _text_projection(df: DataFrame, expr) -> DataFrame:
    t = expr(F.col("text"))
    return df.select("doc_id", TX.text_sha1(t).alias("text_sha1"), F.length(t).alias("n_chars"))


def _text_projection_sql(expr: str) -> str:
    return (f"WITH src AS ({S.src_with_edges()}) "
            f"SELECT doc_id, sha1({expr}) AS text_sha1, length({expr}) AS n_chars FROM src")


@query("normalize_nfc", _text_projection_sql(S.nfc("text")))
def q_normalize_nfc(spark, sf_dir):
    return _text_projection(docs_with_edges(spark, sf_dir), TX.nfc)


@query("strip_control", _text_projection_sql(S.strip_control("text")))
def q_strip_control(spark, sf_dir):
    return _text_projection(docs_with_edges(spark, sf_dir), TX.strip_control)


@query("collapse_ws", _text_projection_sql(S.collapse_ws("text")))
def q_collapse_ws(spark, sf_dir):
    return _text_projection(docs_with_edges(spark, sf_dir), TX.collapse_ws)


@query("normalize_text", _text_projection_sql(S.normalize("text")))
def q_normalize_text(spark, sf_dir):
    return _text_projection(docs_with_edges(spark, sf_dir), TX.normalize_text)


@query("filter_length", f"WITH src AS ({S.src_with_edges()}) SELECT doc_id FROM src "
       f"WHERE length({S.normalize('text')}) BETWEEN 200 AND 200000")
def q_filter_length(spark, sf_dir):
    df = docs_with_edges(spark, sf_dir).withColumn("t", TX.normalize_text(F.col("text")))
    return filters.filter_length(df, "t", 200, 200_000).select("doc_id")


@query("filter_nonblank", f"WITH src AS ({S.src_with_edges()}) SELECT doc_id FROM src WHERE NOT {S.is_blank('text')}")
def q_filter_nonblank(spark, sf_dir):
    return filters.filter_nonblank(docs_with_edges(spark, sf_dir)).select("doc_id")


@query("doc_hash", f"WITH src AS ({S.src_with_edges()}) SELECT doc_id, sha1({S.normalize('text')}) AS doc_hash FROM src")
def q_doc_hash(spark, sf_dir):
    df = docs_with_edges(spark, sf_dir)
    return df.select("doc_id", TX.text_sha1(TX.normalize_text(F.col("text"))).alias("doc_hash"))


@query("dedup_exact", f"WITH {S.classified()} SELECT doc_id, source, doc_hash FROM cls WHERE reason = 'kept'")
def q_dedup_exact(spark, sf_dir):
    return P.kept_rows(P.classify(docs_with_edges(spark, sf_dir))).select("doc_id", "source", "doc_hash")


@query("dedup_exact_raw", "SELECT doc_id, source, sha1(text) AS doc_hash FROM documents "
       "QUALIFY doc_id = min(doc_id) OVER (PARTITION BY sha1(text))")
def q_dedup_exact_raw(spark, sf_dir):
    """Exact dedup on the raw text, no other filter (first doc_id wins)."""
    df = table(spark, sf_dir, "documents").select("doc_id", "source", TX.text_sha1(F.col("text")).alias("doc_hash"))
    return dedup.dedup_exact(df)


@query("fix_mojibake", "SELECT doc_id, 'orig' AS variant, sha1(text) AS text_sha1, false AS repaired FROM documents "
       "UNION ALL SELECT doc_id, 'moji', sha1(text), regexp_matches(text, '[^\\x00-\\x7F]') FROM documents")
def q_fix_mojibake(spark, sf_dir):
    """Every document as is and as Latin-1 mojibake (its UTF-8 bytes read as Latin-1):
    the repair must return the original text for both and leave clean text untouched."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    moji = F.decode(F.encode(F.col("text"), "UTF-8"), "ISO-8859-1")
    both = docs.select("doc_id", F.lit("orig").alias("variant"), F.col("text").alias("t")).unionByName(
        docs.select("doc_id", F.lit("moji").alias("variant"), moji.alias("t")))
    fixed = TX.fix_mojibake(F.col("t"))
    return both.select("doc_id", "variant", TX.text_sha1(fixed).alias("text_sha1"), (fixed != F.col("t")).alias("repaired"))


@F.pandas_udf(T.StringType())
def _misread(texts: pd.Series, pages: pd.Series) -> pd.Series:
    """Texts with their UTF-8 bytes read by a code page, a byte without a character as itself; as they are for the page none."""
    tables = {p: "".join(map(chr, range(0x80))) + TX.page_high(p) for p in pages.unique() if p != "none"}
    return pd.Series([t if t is None or p == "none" else codecs.charmap_decode(t.encode(), "strict", tables[p])[0]
                      for t, p in zip(texts, pages)], dtype=object)


_SOUND, _DAMAGED = "\u0141\u00f3d\u017a \u2014 ", " za\u017c\u00f3\u0142\u0107 g\u0119\u015bl\u0105 ja\u017a\u0144"


@query("fix_mojibake_mixed", f"SELECT doc_id, page, sha1('{_SOUND}' || text || '{_DAMAGED}') AS text_sha1 FROM documents, "
       "(SELECT unnest(['cp1250', 'cp1252', 'latin-1', 'none']) AS page)")
def q_fix_mojibake_mixed(spark, sf_dir):
    """Every document with sound Polish before it and its own UTF-8 misread by one of three pages (or by none): the damaged
    parts are repaired, the sound one stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.lit(_DAMAGED)).alias("t"))
    pages = F.array(*map(F.lit, ["cp1250", "cp1252", "latin-1", "none"]))
    rows = docs.select("doc_id", F.explode(pages).alias("page"), "t").select("doc_id", "page", _misread("t", "page").alias("t"))
    fixed = TX.fix_mojibake(F.concat(F.lit(_SOUND), F.col("t")))
    return rows.select("doc_id", "page", TX.text_sha1(fixed).alias("text_sha1"))


def _ascii_scorer():
    """Label en for texts of ASCII alone; the score is the share of their blank-separated words with a lower-case word in them."""
    import pyarrow.compute as pc

    def score(texts):
        words, lower = pc.count_substring_regex(texts, "[^ ]+"), pc.count_substring_regex(texts, r"\b[a-z]+\b")
        share = pc.min_element_wise(pc.divide(pc.cast(lower, "double"), pc.cast(words, "double")), 1.0)
        return pc.if_else(pc.match_substring_regex(texts, r"[^\x00-\x7F]"), "other", "en"), share
    return score


_SCORED = r"CASE WHEN regexp_matches(norm_text, '[^\x00-\x7F]') THEN false ELSE least(len(regexp_extract_all(norm_text, '\b[a-z]+\b')) / len(regexp_extract_all(norm_text, '[^ ]+')), 1.0) >= 0.9 END"


@query("prepare_run_scorer", f"""WITH norm AS (SELECT doc_id, {S.normalize('text')} AS norm_text FROM documents),
pre AS (SELECT doc_id, norm_text, CASE WHEN coalesce(norm_text, '') = '' THEN 'empty' WHEN length(norm_text) < 200 THEN 'short'
  WHEN length(norm_text) > 200000 THEN 'long' WHEN NOT ({_SCORED}) THEN 'lang' END AS r0 FROM norm),
win AS (SELECT *, min(CASE WHEN r0 IS NULL THEN doc_id END) OVER (PARTITION BY norm_text) AS first_id FROM pre),
cls AS (SELECT coalesce(r0, CASE WHEN doc_id = first_id THEN 'kept' ELSE 'dup' END) AS reason FROM win)
SELECT count(*) AS seen, """ + ", ".join(["count_if(reason = 'kept') AS kept", *(f"count_if(reason = '{r}') AS dropped_{r}" for r in filters.REASONS)])
       + " FROM cls")
def q_prepare_run_scorer(spark, sf_dir):
    """documents written as JSONL files and prepared with a user's scorer as the language gate: the run's counters."""
    lines = table(spark, sf_dir, "documents").select(F.to_json(F.struct("text", "source")).alias("value"))
    raw = jsonl.write_lines(lines, staging_dir(spark, "raw-scored"))
    opts = PrepareOptions(lang="en", lang_scorer=Plugin(_ascii_scorer, "ascii scorer"), lang_min_score=0.9)
    return P.run(spark, raw, staging_dir(spark, "prepared-scored"), opts, glob="*.txt")


@query("default_source", "SELECT doc_id, CASE lang WHEN 'de' THEN 'unknown' WHEN 'es' THEN NULL ELSE source END AS source "
       "FROM documents WHERE lang <> 'fr'")
def q_default_source(spark, sf_dir):
    """Typed text load of JSONL where 'de' rows lack the source key (-> 'unknown') and
    'es' rows carry an explicit null (kept null)."""
    from quarry.plans.q_sources import q_load_text

    return q_load_text(spark, sf_dir).select("doc_id", "source")
