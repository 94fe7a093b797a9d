"""Row filters and the first-fail drop reason of the preparation stage.

Order of checks (each row is counted once, at the first check it fails):
empty -> short -> long -> lang -> dup -> kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.plans.options import PrepareOptions

REASONS = ("empty", "short", "long", "lang", "dup")


def length_ok(c: Column, min_chars: int, max_chars: int) -> Column:
    """Both bounds inclusive, length in code points."""
    return F.length(c).between(min_chars, max_chars)


def filter_length(df: DataFrame, col: str = "text", min_chars: int = 200, max_chars: int = 200_000) -> DataFrame:
    return df.where(length_ok(F.col(col), min_chars, max_chars))


def filter_nonblank(df: DataFrame, col: str = "text") -> DataFrame:
    """Keep rows whose text is not null/empty/whitespace-only (pre-packing filter)."""
    return df.where(~T.is_blank(F.col(col)))


def filter_truthy(df: DataFrame, col: str = "text") -> DataFrame:
    """Keep rows with non-null, non-empty text; whitespace-only text is kept."""
    return df.where(F.coalesce(F.col(col), F.lit("")) != "")


def lang_gate(lang: Column, score: Column | None, target: str, min_score: float) -> Column:
    """Top-1 label must be the target and its score at least ``min_score`` (inclusive)."""
    ok = F.coalesce(lang == F.lit(target), F.lit(False))
    if score is not None:
        ok = ok & F.coalesce(score >= F.lit(min_score), F.lit(False))
    return ok


def with_normalized(df: DataFrame, text_col: str = "text", out: str = "norm_text") -> DataFrame:
    """Add normalized text, its code-point length and SHA-1 fingerprint."""
    return (
        df.withColumn(out, T.normalize_text(F.col(text_col)))
        .withColumn("n_chars", F.length(F.col(out)))
        .withColumn("doc_hash", T.text_sha1(F.col(out)))
    )


def with_prefilter_reason(df: DataFrame, opts: PrepareOptions, text_col: str = "norm_text",
                          lang_ok: Column | None = None) -> DataFrame:
    """Reason for the checks before dedup (null = passed them all).

    ``lang_ok`` is a boolean Column; when None the gate keeps every row (no scorer).
    It is only consulted for rows that passed the cheaper checks.
    """
    t = F.col(text_col)
    n = F.length(t)
    reason = (
        F.when(F.coalesce(t, F.lit("")) == "", F.lit("empty"))
        .when(n < opts.min_chars, F.lit("short"))
        .when(n > opts.max_chars, F.lit("long"))
    )
    if lang_ok is not None:
        reason = reason.when(~lang_ok, F.lit("lang"))
    return df.withColumn("reason", reason)
