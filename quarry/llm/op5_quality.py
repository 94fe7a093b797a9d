"""Quality rules, lines first.

Every line with a word is judged by three rules: punctuation (more than
``MARKS_PCT`` of 100 characters are exclamation, question or symbol marks),
navigation (short labels between two or more separators) and boilerplate (a
stock phrase). Failing lines are removed; a document that so loses more than
``LOST_PCT`` of its word characters is rejected. Documents also fail on base
counts: under ``LEAST_WORDS`` words, or more than ``REPEAT_PCT`` of 100 words in
5-word windows that occur twice or more in the text.

Words are runs of other characters than 0x20 and 0x09-0x0D; lines are split at
line feeds. A null or empty text has no words and fails. Repeated rows are
judged alike, a null doc_id is kept as it is, an empty table gives no rows, and
extra columns are ignored. Texts are taken whole; each row is judged on its own,
so nothing is shuffled. Windows are compared by 64-bit hash within one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.registry import query, table

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"
WIDTH = 5
LEAST_WORDS, REPEAT_PCT, LOST_PCT, MARKS_PCT = 10, 20, 50, 10
#: The rules' patterns.
MARK = "[!?#*$%&|<>=_~^{}]"
NAVIGATION = r"^([^|»›·•>]{1,40}[|»›·•>]){2,}[^|»›·•>]{0,40}\z"
#: The same for Java, whose engine recurses for each repeat of a group unless the loop is possessive.
NAVIGATION_JAVA = NAVIGATION.replace("^(", "^(?:").replace("{2,}", "{2,}+")
PHRASES = ["all rights reserved", "cookie policy", "accept cookies", "privacy policy", "terms of use", "terms of service",
           "click here", "read more", "subscribe now", "subscribe to our", "sign up for", "log in to", "share this",
           "enable javascript", "lorem ipsum", "skip to content", "back to top", "add to cart"]
BOILERPLATE = "(?i)(" + "|".join(PHRASES) + ")"


def bad_line(line: Column) -> Column:
    """Whether a line fails a rule (a line without words never does: it has no marks)."""
    marks = F.regexp_count(line, F.lit(MARK)) * 100 > F.length(line) * MARKS_PCT
    return marks | line.rlike(NAVIGATION_JAVA) | line.rlike(BOILERPLATE)


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("bigint")


def with_repeats(df: DataFrame) -> DataFrame:
    """``df`` with _w (words) and n_repeat_words: positions inside a 5-word window that occurs again."""
    n = F.size("_w")
    rows = df.withColumn("_h", F.when(n >= WIDTH, F.transform(
        F.sequence(F.lit(0), n - WIDTH), lambda i: F.xxhash64(*[F.col("_w")[i + k] for k in range(WIDTH)]))))
    again = F.size(F.array_distinct("_h")) < F.size("_h")
    rows = rows.withColumn("_s", F.when(again, F.sort_array(
        F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))))
    near = F.transform("_s", lambda x, i: F.when(
        (F.get("_s", i - 1)["h"] == x["h"]) | (F.get("_s", i + 1)["h"] == x["h"]), x["at"]))
    rows = rows.withColumn("_p", F.sort_array(F.array_compact(near)))
    covered = F.aggregate(
        "_p", F.struct(F.lit(-WIDTH).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WIDTH), p - a["last"])).alias("n")),
        lambda a: a["n"])
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("_h", "_s", "_p")


def judge(docs: DataFrame, text_col: str = "text", key_col: str = "doc_id") -> DataFrame:
    """(doc_id, text_clean, lines_removed, n_words, ..., base_failed, kept) for every row of ``docs``."""
    rows = docs.select(F.col(key_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    rows = rows.select("doc_id", "_t", F.regexp_extract_all("_t", F.lit(WORD), 0).alias("_w"), F.split("_t", "\n").alias("_l"))
    rows = with_repeats(rows).select(
        "doc_id", "_t", "_l", F.size("_w").cast("bigint").alias("n_words"), "n_repeat_words",
        F.filter("_l", lambda l: l.rlike(WORD)).alias("_lw"), F.filter("_l", lambda l: ~bad_line(l)).alias("_good"))
    rows = rows.select(
        "doc_id", F.array_join("_good", "\n").alias("text_clean"), "n_words", word_chars(F.col("_t")).alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
        (F.size("_lw") - F.size(F.array_distinct("_lw"))).cast("bigint").alias("n_dup_lines"), "n_repeat_words",
        (F.size("_l") - F.size("_good")).cast("bigint").alias("lines_removed"))
    rows = rows.withColumns({
        "chars_left": word_chars(F.col("text_clean")),
        "base_failed": (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PCT * F.col("n_words"))})
    enough = 100 * (F.col("word_chars") - F.col("chars_left")) <= LOST_PCT * F.col("word_chars")
    return rows.withColumn("kept", ~F.col("base_failed") & enough)


_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
    string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
win AS MATERIALIZED (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM (
  SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM t WHERE len(w) >= 5)),
hit AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS m FROM win) WHERE m > 1),
rep AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS place FROM hit) GROUP BY 1),
base AS (
  SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '{SYMBOL}')) AS BIGINT) AS n_symbols,
    list_filter(l, lambda x: regexp_matches(x, '{WORD}')) AS lw,
    list_filter(l, lambda x: NOT (len(regexp_extract_all(x, '{MARK}')) * 100 > length(x) * {MARKS_PCT}
      OR regexp_matches(x, '{NAVIGATION}') OR regexp_matches(x, '{BOILERPLATE}'))) AS good,
    len(l) AS n_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM t LEFT JOIN rep ON rep.doc_id = t.doc_id),
more AS (
  SELECT *, CAST(len(lw) - len(list_distinct(lw)) AS BIGINT) AS n_dup_lines, CAST(n_lines - len(good) AS BIGINT) AS lines_removed,
    length(regexp_replace(array_to_string(good, ' '), '[\x20\x09-\x0D]+', '', 'g')) AS chars_left,
    n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PCT} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * (word_chars - chars_left) <= {LOST_PCT} * word_chars AS kept, lines_removed
FROM more
"""


@query("op5_quality_rules", _SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lines_removed")
