"""Registered queries: language-ID training and scoring, language gate, annotation."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as TX
from quarry.operators import langid as LI
from quarry.plans import sql as S
from quarry.plans.q_sampling import kept
from quarry.plans.registry import query, table

TARGET = "en"
MIN_SCORE = 0.9


def grams_sql(src: str, key: str, text: str) -> str:
    """SELECT key, gram: overlapping trigrams of the lower-cased text, its characters split once."""
    return (f"SELECT {key}, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram "
            f"FROM (SELECT {key}, string_split(lower(replace({text}, chr(10), ' ')), '') AS c FROM {src})")


_TRAIN_CTE = f"""train AS (SELECT lang, {S.normalize('text')} AS t FROM documents WHERE lang IS NOT NULL),
g AS ({grams_sql('train', 'lang', 't')}),
cnt AS MATERIALIZED (SELECT lang, gram, count(*) AS c FROM g GROUP BY ALL),
tot AS (SELECT lang, sum(c) AS total FROM cnt GROUP BY lang),
vsz AS (SELECT count(DISTINCT gram) AS v FROM cnt),
model AS (SELECT cnt.lang, gram, CAST(round(ln((c + 1) / (total + v)) * 1e6) AS BIGINT) AS lp FROM cnt JOIN tot USING (lang), vsz),
langs AS (SELECT lang, CAST(round(ln(1 / (total + v)) * 1e6) AS BIGINT) AS lp0 FROM tot, vsz)"""

def _score_body(src: str, text_col: str) -> str:
    """CTE chain after the training CTEs: scores rows of ``src`` into ``post(doc_id, label, score)``."""
    return f"""dg AS MATERIALIZED (SELECT doc_id, gram, count(*) AS k FROM ({grams_sql(src, 'doc_id', text_col)}) GROUP BY ALL),
known AS (SELECT * FROM dg WHERE gram IN (SELECT gram FROM cnt)),
sc AS MATERIALIZED (SELECT known.doc_id, langs.lang, sum(k * coalesce(model.lp, langs.lp0)) AS s
       FROM known CROSS JOIN langs LEFT JOIN model ON model.lang = langs.lang AND model.gram = known.gram
       GROUP BY ALL),
top AS (SELECT doc_id, max(s) AS top FROM sc GROUP BY doc_id),
post AS (SELECT doc_id, arg_max(lang, (s, lang)) AS label, 1.0 / sum(exp((s - top) / 1e6)) AS score
         FROM sc JOIN top USING (doc_id) GROUP BY doc_id)"""


_SCORE_CTE = f"""{S.kept()}, {_TRAIN_CTE},
{_score_body('kept', 'norm_text')}"""


def _model(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(TX.normalize_text(F.col("text")).alias("text"), "lang")
    return LI.train(docs, "text", "lang")


@query("langid_train", f"WITH {_TRAIN_CTE} SELECT lang, gram, lp FROM model")
def q_langid_train(spark, sf_dir):
    model, _ = _model(spark, sf_dir)
    return model.select("lang", "gram", "lp")


def _scored(spark, sf_dir):
    docs = kept(spark, sf_dir).select("doc_id", "n_chars", F.col("norm_text").alias("text"))
    return docs, LI.score(docs, _model(spark, sf_dir), "text", "doc_id")


@query("langid_score", f"WITH {_SCORE_CTE} SELECT doc_id, label, round(score, 6) AS score FROM post")
def q_langid_score(spark, sf_dir):
    _, sc = _scored(spark, sf_dir)
    return sc.select("doc_id", "label", F.round("score", 6).alias("score"))


@query("filter_language", f"WITH {_SCORE_CTE} SELECT doc_id FROM post WHERE label = '{TARGET}' AND score >= {MIN_SCORE}")
def q_filter_language(spark, sf_dir):
    from quarry.operators.filters import lang_gate

    _, sc = _scored(spark, sf_dir)
    return sc.where(lang_gate(F.col("label"), F.col("score"), TARGET, MIN_SCORE)).select("doc_id")


@query("annotate_docs", f"WITH {_SCORE_CTE} SELECT kept.doc_id, kept.n_chars, post.label AS lang, "
       "round(post.score, 6) AS lang_score FROM kept LEFT JOIN post USING (doc_id)")
def q_annotate_docs(spark, sf_dir):
    docs, sc = _scored(spark, sf_dir)
    return docs.join(sc, on="doc_id", how="left").select(
        "doc_id", "n_chars", F.col("label").alias("lang"), F.round("score", 6).alias("lang_score"))


_GATED_SQL = f"""WITH src AS ({S.src_with_edges()}),
norm AS (SELECT doc_id, source, lang, {S.normalize('text')} AS norm_text FROM src),
pre AS (SELECT *, length(norm_text) AS n_chars, sha1(norm_text) AS doc_hash,
    CASE WHEN coalesce(norm_text, '') = '' THEN 'empty' WHEN length(norm_text) < 200 THEN 'short'
         WHEN length(norm_text) > 200000 THEN 'long' END AS r0 FROM norm),
passed AS (SELECT doc_id, norm_text FROM pre WHERE r0 IS NULL),
{_TRAIN_CTE},
{_score_body('passed', 'norm_text')},
gate AS (SELECT pre.*, CASE WHEN r0 IS NOT NULL THEN r0
    WHEN NOT (coalesce(post.label = '{TARGET}', false) AND coalesce(post.score >= {MIN_SCORE}, false)) THEN 'lang' END AS r1
    FROM pre LEFT JOIN post USING (doc_id)),
win AS (SELECT *, min(CASE WHEN r1 IS NULL THEN doc_id END) OVER (PARTITION BY doc_hash) AS first_id FROM gate),
cls AS (SELECT coalesce(r1, CASE WHEN doc_id = first_id THEN 'kept' ELSE 'dup' END) AS reason FROM win)
SELECT count(*) AS seen, count_if(reason = 'kept') AS kept, count_if(reason = 'empty') AS dropped_empty,
  count_if(reason = 'short') AS dropped_short, count_if(reason = 'long') AS dropped_long,
  count_if(reason = 'lang') AS dropped_lang, count_if(reason = 'dup') AS dropped_dup FROM cls"""


@query("prepare_stats_ngram", _GATED_SQL)
def q_prepare_stats_ngram(spark, sf_dir):
    """Preparation counters with the trained trigram scorer as the language gate ('en' >= 0.9)."""
    from quarry.plans import prepare as P
    from quarry.plans.options import PrepareOptions
    from quarry.plans.registry import docs_with_edges

    opts = PrepareOptions(lang=TARGET, lang_scorer="ngram", lang_min_score=MIN_SCORE)
    return P.stats(P.classify(docs_with_edges(spark, sf_dir), opts, lang_model=_model(spark, sf_dir)))
