"""Mixing sources to target weights: raked token weights, then calibrated sampling.

Documents fall into cells (source, language, topic). Iterative proportional
fitting scales the cells' token weights to the target total of each source,
then of each language, then of each topic, ``rounds`` times over. No weight
goes above ``1 / keep`` (it is cut there in every step), so ``keep * weight`` is
a probability; a document is taken when its uniform number, from the md5 of
seed and doc_id, lies below it. The expected sample holds ``keep`` of all
tokens, in the target proportions as far as the cut lets them be met.

Topics come from ``TOPICS``: the first pattern found in the text, else the last
name. Tokens are words (runs of other characters than 0x20 and 0x09-0x0D). A
value without a target keeps its present total. Null sources, languages and
texts count as empty strings; a null doc_id as an empty one. Cells without
tokens keep weight 1. Rows that repeat a doc_id share their uniform number. An
empty table gives no rows. Extra columns are ignored by ``sample`` and kept by
``keep_sampled``.

Fitting runs on the cell table alone, each step written to the staging folder;
texts are read twice and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.registry import fresh, query, table
from quarry.session import stage

#: Fixed values of the query: topics by pattern, the rest is "prose".
TOPICS = [("legal", "[Ll]icen[sc]e|[Cc]opyright"), ("contact", "@|[+][0-9]"), ("figures", "[0-9]"), ("prose", "")]
KEEP = 0.5
ALPHA = 0.7
ROUNDS = 8
SEED = 42
DIMS = ("source", "lang", "topic")


def topic(text: Column, topics=TOPICS) -> Column:
    out = F.lit(topics[-1][0])
    for name, pattern in reversed(topics[:-1]):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def measured(docs: DataFrame, text_col: str = "text") -> dict[str, Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return {"source": F.coalesce("source", F.lit("")), "lang": F.coalesce("lang", F.lit("")), "topic": topic(text),
            "tokens": F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")}


def tempered(cells: DataFrame, dim: str, alpha: float = ALPHA) -> DataFrame:
    """(dim, target): token totals that are as large together, in proportion to total ** alpha."""
    totals = cells.groupBy(dim).agg(F.sum("tokens").alias("_n"))
    whole = totals.select(F.sum("_n").cast("double")).scalar()
    powers = totals.select(F.sum(F.pow(F.col("_n").cast("double"), F.lit(alpha)))).scalar()
    return totals.select(dim, (F.pow(F.col("_n").cast("double"), F.lit(alpha)) / powers * whole).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], most: float, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (the dimensions and tokens) with their weight. ``targets``: (dimension, target tokens) by dimension."""
    cells = stage(cells.withColumn("weight", F.lit(1.0)), "mix-cells")
    for _ in range(rounds):
        for dim, target in targets.items():
            now = cells.groupBy(dim).agg(F.sum(F.col("tokens") * F.col("weight")).alias("_now"))
            factor = now.join(target, dim, "left").select(
                dim, F.when(F.col("_now") > 0, F.coalesce("target", "_now") / F.col("_now")).otherwise(1.0).alias("_f"))
            cells = stage(cells.join(factor, dim).select(
                *targets, "tokens", F.least(F.lit(most), F.col("weight") * F.col("_f")).alias("weight")), "mix-cells")
    return cells


def uniform(key_col: str = "doc_id", seed: int = SEED) -> Column:
    """A number in [0, 1) from the first 52 bits of md5(seed:key)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key_col).cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def probabilities(docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP,
                  rounds: int = ROUNDS) -> DataFrame:
    """(source, lang, topic, tokens, weight) for every cell of ``docs``."""
    cells = docs.select(*[c.alias(n) for n, c in measured(docs).items()]).groupBy(*DIMS).agg(F.sum("tokens").alias("tokens"))
    cells = stage(cells, "mix-totals")
    targets = targets or {d: stage(tempered(cells, d), "mix-target") for d in DIMS}
    return rake(cells, targets, 1 / keep, rounds)


def _weighted(docs: DataFrame, cells: DataFrame, keep: float, key_col: str) -> DataFrame:
    """``docs`` with a column ``fresh(docs, "_mix")``: source, lang, topic, tokens, weight, prob, kept."""
    m = measured(docs)
    mix, key, weight = (fresh(docs, n) for n in ("_mix", "_cell", "_weight"))
    rows = docs.withColumn(mix, F.struct(*[c.alias(n) for n, c in m.items()]))
    cell = cells.select(F.struct(*DIMS).alias(key), F.col("weight").alias(weight))
    prob = F.least(F.lit(1.0), F.lit(keep) * F.col(weight))
    return rows.join(cell, F.struct(*[F.col(f"{mix}.{d}").alias(d) for d in DIMS]) == F.col(key)).select(
        *[docs[c] for c in docs.columns], F.struct(f"{mix}.*", F.col(weight).alias("weight"), prob.alias("prob"),
                                                  (uniform(key_col) < prob).alias("kept")).alias(mix))


def sample(docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP, rounds: int = ROUNDS,
           key_col: str = "doc_id") -> DataFrame:
    """Every document with its cell, tokens, weight, probability and whether it is taken."""
    docs = docs.select(F.col(key_col).alias("doc_id"), "source", "lang", "text")
    return _weighted(docs, probabilities(docs, targets, keep, rounds), keep, "doc_id").select(
        "doc_id", "_mix.source", "_mix.lang", "_mix.topic", "_mix.tokens", F.round("_mix.weight", 6).alias("weight"),
        F.round("_mix.prob", 6).alias("prob"), "_mix.kept")


def keep_sampled(docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP,
                 rounds: int = ROUNDS, key_col: str = "doc_id") -> DataFrame:
    """The documents that are taken, with their columns."""
    mix = fresh(docs, "_mix")
    return _weighted(docs, probabilities(docs, targets, keep, rounds), keep, key_col).where(F.col(f"{mix}.kept")).drop(mix)


def _sql() -> str:
    cases = " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for n, p in TOPICS[:-1])
    most = 1 / KEEP
    out = [f"""WITH doc AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, CASE {cases} ELSE '{TOPICS[-1][0]}' END AS topic,
    CAST(len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
c0 AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(1.0 AS DOUBLE) AS weight FROM doc GROUP BY ALL)"""]
    for d in DIMS:
        out.append(f"""n_{d} AS (SELECT {d}, CAST(sum(tokens) AS DOUBLE) AS n FROM c0 GROUP BY 1),
t_{d} AS MATERIALIZED (SELECT {d}, pow(n, {ALPHA}) / (SELECT sum(pow(n, {ALPHA})) FROM n_{d}) * (SELECT sum(n) FROM n_{d}) AS target FROM n_{d})""")
    k = 0
    for _ in range(ROUNDS):
        for d in DIMS:
            out.append(f"""c{k + 1} AS MATERIALIZED (
  SELECT c.source, c.lang, c.topic, c.tokens, least({most}, c.weight * CASE WHEN s.now > 0 THEN t.target / s.now ELSE 1.0 END) AS weight
  FROM c{k} c JOIN (SELECT {d}, sum(tokens * weight) AS now FROM c{k} GROUP BY 1) s USING ({d}) JOIN t_{d} t USING ({d}))""")
            k += 1
    u = (f"CAST(('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) "
         f"/ CAST({1 << 52} AS DOUBLE)")
    return ",\n".join(out) + f"""
SELECT doc_id, source, lang, topic, doc.tokens AS tokens, round(weight, 6) AS weight, round(least(1.0, {KEEP} * weight), 6) AS prob,
  {u} < least(1.0, {KEEP} * weight) AS kept
FROM doc JOIN c{k} USING (source, lang, topic)
"""


@query("op3_mixing", _sql())
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample(table(spark, sf_dir, "documents"))
