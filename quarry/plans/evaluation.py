"""Evaluation of a scorer from files: suites of benchmarks, one JSON report.

``run`` looks a suite up by its name, reads each benchmark's file, scores it and
writes ``{checkpoint, suite, results: [{name, kind, metric, value, extra}]}``. The
scorer is a function of (rows (id, text), most tokens of a text or None) that
returns (id, nll in micro-nats, n_tokens); ``lm_scorer`` makes one of a trained
bigram model, a table of a model's own scores can be another.

A held-out text benchmark reads the truthy texts of its file; a multiple-choice one
scores question, cue and choice of every item, whole, and the least score wins.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import evaluate as EV
from quarry.operators import lm as LM
from quarry.operators import tokens as TK
from quarry.session import stage
from quarry.sources import jsonl, sinks

Scorer = Callable[[DataFrame, "int | None"], DataFrame]

# Defaults of a benchmark.
TEXT_FIELD = "text"
MAX_SEQ_LENGTH = 2048


def lm_scorer(vocab: DataFrame, model: tuple[DataFrame, DataFrame], n_ids: int, k: float = 1.0) -> Scorer:
    """A scorer by the bigram model: texts are tokenized, cut to the most tokens and scored."""
    def score(rows: DataFrame, most: int | None) -> DataFrame:
        ids = TK.tokenize(rows, vocab, "text", "id")
        if most is not None:
            ids = ids.withColumn("ids", TK.truncate(F.col("ids"), most))
        return LM.nll(ids, model, n_ids, k, key_col="id")
    return score


def _numbered(rows: DataFrame, name: str, id_col: str) -> DataFrame:
    """The rows under a short id, staged: it stays the same however often they are read."""
    return stage(rows.withColumn(id_col, F.monotonically_increasing_id()), name)


def run_perplexity(spark: SparkSession, name: str, cfg: Mapping, scorer: Scorer) -> DataFrame:
    """Report row of a held-out text file (``path``, ``text_field``, ``max_seq_length``: None for whole texts)."""
    rows = jsonl.eval_text_scan(spark, cfg["path"], cfg.get("text_field", TEXT_FIELD), cfg.get("glob", jsonl.GLOB))
    texts = _numbered(rows.select("text"), "eval-texts", "id")
    return EV.perplexity_report(name, EV.perplexity(scorer(texts, cfg.get("max_seq_length", MAX_SEQ_LENGTH))))


def run_multiple_choice(spark: SparkSession, name: str, cfg: Mapping, scorer: Scorer) -> DataFrame:
    """Report row of a multiple-choice file (``path``): accuracy, correct, total."""
    rows = jsonl.load_mcqa(spark, cfg["path"], cfg.get("glob", jsonl.GLOB))
    items = _numbered(rows.select("question", "choices", "answer_index"), "eval-items", "item_id")
    prompts = _numbered(EV.expand_choices(items).select("item_id", "choice_index", F.col("prompt").alias("text")), "eval-prompts", "id")
    scores = prompts.select("id", "item_id", "choice_index").join(scorer(prompts.select("id", "text"), None), "id")
    gold = items.select("item_id", F.col("answer_index").alias("gold"))
    return EV.mcqa_report(name, EV.accuracy(EV.predict(scores, score_col="nll"), gold))


def run(spark: SparkSession, checkpoint: str, suite: str, output: str, suites: Mapping[str, Sequence[str]],
        benchmarks: Mapping[str, Mapping], scorer: Scorer) -> DataFrame:
    """Run a suite, write its report to ``output`` and return the report's rows (name, kind, metric, value, extra).

    An unknown suite or benchmark raises before anything is scored. A benchmark of an unknown kind is skipped with a
    warning; a multiple-choice file that is not there gives a row with value NaN and extra {skipped: 1}.
    """
    if suite not in suites:
        raise KeyError(f"unknown suite {suite!r}, known: {', '.join(sorted(suites))}")
    unknown = [b for b in suites[suite] if b not in benchmarks]
    if unknown:
        raise KeyError(f"unknown benchmarks in suite {suite!r}: {', '.join(unknown)}")
    runners = {kind: (lambda name, cfg, run_one=run_one: run_one(spark, name, cfg, scorer))
               for kind, run_one in (("perplexity", run_perplexity), ("multiple_choice", run_multiple_choice))}
    report = stage(EV.run_suite(spark, list(suites[suite]), dict(benchmarks), runners).coalesce(1), "eval-report")
    sinks.write_report(report, output, checkpoint, suite)
    return report


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """(checkpoint, suite, name, kind, metric, value, extra) of a written report."""
    row = EV.REPORT_SCHEMA.simpleString()
    doc = spark.read.schema(f"checkpoint string, suite string, results array<{row}>").json(path)
    return doc.select("checkpoint", "suite", F.inline("results"))
