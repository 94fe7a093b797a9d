"""Evaluation aggregates: perplexity, multiple-choice prediction/accuracy, reports.

Inputs are score tables: ``(id, nll, n_tokens)`` with nll in micro-nats (from
``lm.nll`` or any external scorer) and ``(item_id, choice_index, score)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.instructions import ANSWER_CUE
from quarry.session import path_exists

MICRO = 1_000_000.0

REPORT_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("extra", T.MapType(T.StringType(), T.DoubleType())),
])


def perplexity(scores: DataFrame, nll_col: str = "nll", n_col: str = "n_tokens") -> DataFrame:
    """One row: n_tokens, nll_sum, loss = nll_sum / max(n_tokens, 1), perplexity = exp(loss).
    An empty score table gives n_tokens 0, loss 0 and perplexity 1."""
    agg = scores.agg(F.coalesce(F.sum(n_col), F.lit(0)).cast("bigint").alias("n_tokens"),
                     (F.coalesce(F.sum(nll_col), F.lit(0)) / F.lit(MICRO)).alias("nll_sum"))
    loss = F.col("nll_sum") / F.greatest(F.col("n_tokens"), F.lit(1))
    return agg.select("n_tokens", "nll_sum", loss.alias("loss"), F.exp(loss).alias("perplexity"))


def perplexity_of_losses(losses: DataFrame, loss_col: str = "loss", n_col: str = "n_tokens") -> DataFrame:
    """The same row from a score table of mean losses: (id, loss, n_tokens) with loss per token in nats."""
    return perplexity(losses.select((F.col(loss_col) * F.col(n_col) * F.lit(MICRO)).alias("nll"),
                                    F.col(n_col).alias("n_tokens")))


def perplexity_json(ppl: DataFrame) -> DataFrame:
    """One column ``value``: the perplexity row as a JSON document."""
    return ppl.select(F.to_json(F.struct("perplexity", "loss", "n_tokens")).alias("value"))


def mcqa_prompt(question: Column, choice: Column) -> Column:
    """The whole prompt is scored: question, answer cue, choice."""
    return F.concat(question, F.lit(ANSWER_CUE), choice)


def expand_choices(items: DataFrame) -> DataFrame:
    """(question, choices, answer_index) rows -> one row per (item, choice_index, prompt). An item without choices fails the job."""
    none = F.raise_error(F.concat(F.lit("no choices in item "), F.col("item_id").cast("string")))
    items = items.where(F.when(F.coalesce(F.size("choices"), F.lit(0)) < 1, none).isNull())
    return items.select("item_id", "question", "answer_index",
                        F.posexplode("choices").alias("choice_index", "choice")).withColumn(
        "prompt", mcqa_prompt(F.col("question"), F.col("choice")))


def predict(scores: DataFrame, item_col: str = "item_id", idx_col: str = "choice_index",
            score_col: str = "score") -> DataFrame:
    """Arg-min score per item; ties go to the lowest choice index."""
    return scores.groupBy(item_col).agg(
        F.min_by(F.col(idx_col), F.struct(F.col(score_col), F.col(idx_col))).alias("pred"))


def accuracy(pred: DataFrame, gold: DataFrame, item_col: str = "item_id") -> DataFrame:
    """One row: correct, total, accuracy (0.0 when there are no items). Every gold item counts: one without a
    prediction, or with a gold that no choice has, is wrong."""
    j = gold.join(pred, on=item_col, how="left")
    agg = j.agg(F.count_if(F.col("pred") == F.col("gold")).alias("correct"), F.count(F.lit(1)).alias("total"))
    return agg.withColumn("accuracy", F.when(F.col("total") > 0, F.col("correct") / F.col("total")).otherwise(F.lit(0.0)))


def report_row(name: str, kind: str, metric: str, value: Column, extra: dict[str, Column]) -> list[Column]:
    m = F.create_map(*[x for k, v in extra.items() for x in (F.lit(k), v.cast("double"))]) if extra else \
        F.create_map().cast("map<string,double>")
    return [F.lit(name).alias("name"), F.lit(kind).alias("kind"), F.lit(metric).alias("metric"),
            value.cast("double").alias("value"), m.alias("extra")]


def perplexity_report(name: str, ppl: DataFrame) -> DataFrame:
    return ppl.select(*report_row(name, "perplexity", "perplexity", F.col("perplexity"),
                                  {"loss": F.col("loss"), "n_tokens": F.col("n_tokens")}))


def mcqa_report(name: str, acc: DataFrame) -> DataFrame:
    return acc.select(*report_row(name, "multiple_choice", "accuracy", F.col("accuracy"),
                                  {"correct": F.col("correct"), "total": F.col("total")}))


def skipped_report(spark: SparkSession, name: str) -> DataFrame:
    """Missing benchmark file: value NaN, extra {skipped: 1}."""
    return spark.createDataFrame([(name, "multiple_choice", "accuracy", float("nan"), {"skipped": 1.0})], REPORT_SCHEMA)


def run_suite(spark: SparkSession, suite: list[str], benchmarks: dict[str, dict], runners: dict) -> DataFrame:
    """Expand a suite into benchmark reports. Unknown kinds are skipped (with a warning);
    an unknown benchmark name raises. A multiple-choice benchmark whose ``path``
    does not exist yields a skipped row."""
    import warnings

    out = None
    for name in suite:
        cfg = benchmarks[name]  # KeyError for an unknown benchmark, like an unknown suite
        kind = cfg.get("kind", "perplexity")
        if kind not in runners:
            warnings.warn(f"unknown benchmark kind {kind}, skipping")
            continue
        path = cfg.get("path")
        if kind == "multiple_choice" and path is not None and not path_exists(spark, path):
            df = skipped_report(spark, name)
        else:
            df = runners[kind](name, cfg)
        out = df if out is None else out.unionByName(df)
    return out if out is not None else spark.createDataFrame([], REPORT_SCHEMA)


def compare_reports(base: DataFrame, candidate: DataFrame, targets: dict[str, tuple[str, float]]) -> DataFrame:
    """Join two reports on name: (name, base, candidate, delta, passed).

    ``targets[name] = (rule, amount)`` with rule 'rel_drop' (candidate <= base * (1 - amount)),
    'min_gain' (candidate - base >= amount) or 'max_drop' (base - candidate <= amount).
    """
    j = base.select("name", F.col("value").alias("base")).join(
        candidate.select("name", F.col("value").alias("candidate")), on="name", how="inner")
    delta = F.col("candidate") - F.col("base")
    passed = F.lit(None).cast("boolean")
    for name, (rule, amount) in targets.items():
        if rule == "rel_drop":
            ok = F.col("candidate") <= F.col("base") * F.lit(1.0 - amount)
        elif rule == "min_gain":
            ok = delta >= F.lit(amount)
        elif rule == "max_drop":
            ok = -delta <= F.lit(amount)
        else:
            raise ValueError(rule)
        passed = F.when(F.col("name") == name, ok).otherwise(passed)
    return j.select("name", "base", "candidate", delta.alias("delta"), passed.alias("passed"))
