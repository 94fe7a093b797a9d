"""URL filter: a trie over reversed host labels, then path segments.

A rule is ``(verdict, host, path)``. It fits its host and every subdomain when
the url's path starts with the rule's path. The longest rule wins (characters
of host and path together; then the longer host; then ``block`` over
``allow``). A url that no rule fits gets ``default``.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased. Path: from there up to ``?``, ``#`` or the end. A null url, or one
without ``://``, has an empty host and path and gets the default. Repeated
rules count once; rules are taken whole, without trimming. Input columns are
kept unless the caller selects; output columns replace clashing names.

The trie is broadcast while the rules stay under ``TRIE_BYTES`` (checked);
larger rule sets go through ``match_by_join``, which joins each url's host
suffixes and whole path segments with the rules and keeps the longest.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from quarry.llm.registry import fresh, query, table

#: The rules of the query.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
TRIE_BYTES = 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url):
    """(host, path) columns of a url column."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def rank(verdict: str, host: str, path: str) -> tuple:
    return len(host) + len(path), len(host), verdict == "block"


def build_trie(rules) -> dict:
    """Nested dicts: host labels from the last to the first, then ``/`` to the path segments.

    A path node holds whole segments as keys; ``*`` holds the rules that end
    there, each with the started last segment it still asks for.
    """
    root: dict = {}
    for verdict, host, path in set(rules):
        node = root
        for label in reversed(host.split(".")):
            node = node.setdefault("h", {}).setdefault(label, {})
        *whole, started = path.split("/")
        for segment in whole:
            node = node.setdefault("p", {}).setdefault(segment, {})
        node.setdefault("*", []).append((started, rank(verdict, host, path), host + path, verdict))
    return root


def longest(trie: dict, host: str, path: str):
    """The winning (rule string, verdict), or None."""
    best = None
    segments = path.split("/")

    def along(node: dict) -> None:
        nonlocal best
        for i, segment in enumerate(segments):
            for started, order, rule, verdict in node.get("*", ()):
                if segment.startswith(started) and (best is None or order > best[0]):
                    best = (order, rule, verdict)
            node = node.get("p", {}).get(segment) if i + 1 < len(segments) else None
            if node is None:
                return

    node = trie
    for label in reversed(host.split(".")):
        node = node.get("h", {}).get(label)
        if node is None:
            break
        along(node)
    return best and best[1:]


def match_by_trie(df: DataFrame, rules, default: str = "allow", url_col: str = "url") -> DataFrame:
    trie = df.sparkSession.sparkContext.broadcast(build_trie(rules))

    @pandas_udf("rule string, verdict string")
    def judge(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = [longest(trie.value, h, p) or (None, default) for h, p in zip(host, path)]
        return pd.DataFrame(found, columns=["rule", "verdict"])

    host, path = split_url(F.col(url_col))
    judged = fresh(df, "_judged")
    out = df.withColumns({"host": host, "path": path}).withColumn(judged, judge("host", "path"))
    return out.withColumns({"rule": F.col(f"{judged}.rule"), "verdict": F.col(f"{judged}.verdict")}).drop(judged)


def match_by_join(df: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url") -> DataFrame:
    """The same result for rule sets of any size: a join on (host suffix, whole segments)."""
    host, path = split_url(F.col(url_col))
    row, found = fresh(df, "_row"), fresh(df, "_found")
    rows = df.withColumns({"host": host, "path": path, row: F.monotonically_increasing_id()})
    labels, parts = F.split("host", r"\."), F.split("path", "/")
    keys = rows.select(F.col(row).alias("_row"), "path", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("_h"))
    keys = keys.select("_row", "path", "_h", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, F.lit(1), i - 1), "/"))).alias("_s"))
    ruled = rules.distinct().select(
        "verdict", F.col("host").alias("_h"), F.col("path").alias("_p"),
        F.regexp_replace("path", "/?[^/]*$", "").alias("_s"))
    order = F.struct(F.length("_h") + F.length("_p"), F.length("_h"), (F.col("verdict") == "block").cast("int"))
    best = keys.join(ruled, ["_h", "_s"]).where(F.col("path").startswith(F.col("_p"))).groupBy("_row").agg(
        F.max_by(F.struct(F.concat("_h", "_p").alias("rule"), "verdict"), order).alias(found)).withColumnRenamed("_row", row)
    out = rows.drop("rule", "verdict").join(best, row, "left")
    return out.withColumns({"rule": F.col(f"{found}.rule"), "verdict": F.coalesce(f"{found}.verdict", F.lit(default))}).drop(
        found, row)


def url_filter(df: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url",
               trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """``df`` with host, path, rule and verdict. ``rules``: verdict, host, path."""
    rules = rules.select("verdict", "host", "path").where("host is not null and path is not null").distinct()
    held = rules.select(F.sum(F.octet_length("host") + F.octet_length("path") + 512)).scalar()
    held = rules.sparkSession.range(1).select(F.coalesce(held, F.lit(0))).first()[0]
    if held <= trie_bytes:
        return match_by_trie(df, [tuple(r) for r in rules.collect()], default, url_col)
    return match_by_join(df, rules, default, url_col)


def _sql() -> str:
    fits = "\n".join(
        f"  WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v} {h}{p}'"
        for v, h, p in sorted(RULES, key=lambda r: rank(*r), reverse=True))
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fit AS (SELECT *, CASE {fits} END AS f FROM parts)
SELECT page_id, host, path, split_part(f, ' ', 2) AS rule, coalesce(split_part(f, ' ', 1), 'allow') AS verdict FROM fit
"""


@query("op1_url_filters", _sql())
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, rules).select("page_id", "host", "path", "rule", "verdict")
