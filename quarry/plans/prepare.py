"""Corpus preparation: normalize -> length -> language -> exact dedup -> split/shard.

``classify`` gives every input row exactly one reason (empty, short, long, lang,
dup, kept); ``stats`` folds those into the seven counters with one aggregate;
``run`` decides the same on narrow rows (``decide``, ``places``) and writes the kept
texts as train/val shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quarry.functions.text import fix_mojibake
from quarry.operators import dedup, filters, near_links, plugins, sampling
from quarry.plans.options import PrepareOptions
from quarry.session import path_exists, shuffles_removed, stage

TEXT_CODEC = "zstd"  # of staged texts
STATS_COLUMNS = ["seen", "kept", "dropped_empty", "dropped_short", "dropped_long", "dropped_lang", "dropped_dup"]


def language_ok(df: DataFrame, opts: PrepareOptions, lang_model: DataFrame | None = None,
                text_col: str = "norm_text", key_col: str = "doc_id") -> tuple[DataFrame, Column | None]:
    """Resolve the language gate: returns (df with score columns, boolean Column or None)."""
    if opts.lang_scorer is None:
        return df, None
    if isinstance(opts.lang_scorer, plugins.Plugin):
        scored = df.withColumn("_lid", plugins.scored(opts.lang_scorer, F.col(text_col)))
        return scored, filters.lang_gate(F.col("_lid.label"), F.col("_lid.score"), opts.lang, opts.lang_min_score)
    if opts.lang_scorer == "columns":
        score = F.col(opts.lang_score_col) if opts.lang_score_col else None
        return df, filters.lang_gate(F.col(opts.lang_col), score, opts.lang, opts.lang_min_score)
    if opts.lang_scorer == "ngram":
        from quarry.operators import langid

        if lang_model is None:
            raise ValueError("lang_scorer='ngram' needs a trained lang_model")
        scored = langid.with_scores(df, lang_model, text_col=text_col, key_col=key_col,
                              label_col="_lid_label", score_col="_lid_score")
        return scored, filters.lang_gate(F.col("_lid_label"), F.col("_lid_score"), opts.lang, opts.lang_min_score)
    raise ValueError(f"unknown lang_scorer {opts.lang_scorer!r}")


def judged(df: DataFrame, opts: PrepareOptions = PrepareOptions(), text_col: str = "text", key_col: str = "doc_id",
           lang_model: DataFrame | None = None) -> DataFrame:
    """Add norm_text, n_chars, doc_hash and the ``reason`` of the first check of the row alone that fails (null: none)."""
    if opts.fix_mojibake:
        df = df.withColumn(text_col, fix_mojibake(F.col(text_col)))
    norm = filters.with_normalized(df, text_col=text_col)
    norm = filters.with_prefilter_reason(norm, opts)  # empty / short / long
    if opts.lang_scorer is None:
        return norm
    # score only rows that passed the cheap checks
    gated = norm.withColumn("_gate_text", F.when(F.col("reason").isNull(), F.col("norm_text")))
    gated, ok = language_ok(gated, opts, lang_model, text_col="_gate_text", key_col=key_col)
    return gated.withColumn(
        "reason", F.when(F.col("reason").isNull() & ~ok, F.lit("lang")).otherwise(F.col("reason"))
    ).drop("_gate_text", "_lid", "_lid_label", "_lid_score")


def with_duplicates(norm: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """``judged`` rows, whole or narrow, with the last reasons: dup for later copies of a text, else kept."""
    marked = dedup.mark_duplicates(norm, F.col("reason").isNull(), key_col=key_col)
    return marked.withColumn(
        "reason", F.coalesce(F.col("reason"), F.when(F.col("is_dup"), F.lit("dup")), F.lit("kept"))
    ).drop("is_dup")


def classify(df: DataFrame, opts: PrepareOptions = PrepareOptions(), text_col: str = "text",
             key_col: str = "doc_id", lang_model: DataFrame | None = None, staged: bool = True) -> DataFrame:
    """Add norm_text, n_chars, doc_hash and the first-fail ``reason`` (kept = passed all)."""
    norm = judged(df, opts, text_col, key_col, lang_model)
    return with_duplicates(stage(norm, "classified") if staged else norm, key_col)


def counters(reasons: tuple[str, ...] = tuple(filters.REASONS)) -> list[Column]:
    """The aggregates seen, kept, dropped_* over rows with a reason."""
    r = F.col("reason")
    return [F.count(F.lit(1)).alias("seen"), F.count_if(r == "kept").alias("kept"),
            *[F.count_if(r == x).alias(f"dropped_{x}") for x in reasons]]


def stats(classified: DataFrame, reasons: tuple[str, ...] = tuple(filters.REASONS)) -> DataFrame:
    """One row: seen, kept, dropped_* (BIGINT). Invariant: seen = kept + sum(dropped_*)."""
    return classified.agg(*counters(reasons))


def quick_stats(df: DataFrame, opts: PrepareOptions = PrepareOptions(), text_col: str = "text",
                key_col: str = "doc_id", lang_model: DataFrame | None = None) -> DataFrame:
    """The counters of ``stats(classify(df))`` without per-row dup flags.

    Duplicates among the rows that passed every other check are
    ``#rows - #distinct fingerprints``, so one scan and one narrow aggregate
    suffice: no staging, no join back.
    """
    norm = judged(df, opts, text_col, key_col, lang_model)
    r = F.col("reason")
    passed = r.isNull()
    agg = norm.agg(
        F.count(F.lit(1)).alias("seen"),
        F.count_distinct(F.when(passed, F.col("doc_hash"))).alias("kept"),
        *[F.count_if(r == x).alias(f"dropped_{x}") for x in filters.REASONS if x != "dup"],
        F.count_if(passed).alias("_passed"),
    )
    return agg.select("seen", "kept", *[f"dropped_{x}" for x in filters.REASONS if x != "dup"],
                      (F.col("_passed") - F.col("kept")).alias("dropped_dup"))


def kept_texts(df: DataFrame, opts: PrepareOptions = PrepareOptions(), text_col: str = "text", key_col: str = "doc_id",
               lang_model: DataFrame | None = None) -> DataFrame:
    """(key, norm_text) of ``kept_rows(classify(df))``. The texts are staged once, and only keys and fingerprints are exchanged."""
    norm = judged(df, opts, text_col, key_col, lang_model)
    passed = F.col("reason").isNull()
    # the filter comes after the stage: pushed down, it would repeat the normalization
    held = stage(norm.select(key_col, F.when(passed, F.col("norm_text")).alias("norm_text"), F.unhex("doc_hash").alias("doc_hash"), "reason"),
                 "passed-texts", TEXT_CODEC).where(passed)
    return dedup.first_rows(held, "doc_hash", key_col).select(key_col, "norm_text")


def kept_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reason") == "kept")


def zero_stats(spark) -> DataFrame:
    return spark.createDataFrame([tuple([0] * len(STATS_COLUMNS))], STATS_COLUMNS)


def drop_near_duplicates(decided: DataFrame, texts: DataFrame, opts: PrepareOptions, key_col: str = "doc_id") -> DataFrame:
    """``decided`` with the reason ``near_dup`` for kept rows that a row before them in the order of ``key_col`` stands for.

    ``texts``: (key, norm_text). The rows are compared under their rank in that order, a number, whatever the type of the key.
    """
    ranks = stage(sampling.order_rank(decided.where(F.col("reason") == "kept"), [key_col]), "near-ranks")
    docs = stage(texts.select(key_col, "norm_text").join(ranks, key_col).select("rank", F.col("norm_text").alias("text")), "near-texts", TEXT_CODEC)
    clusters = near_links.near_dup_clusters(docs, opts.near_dup, "text", "rank")
    gone = clusters.where("rank <> cluster").select("rank").join(ranks, "rank").select(key_col, F.lit(True).alias("_near"))
    return decided.join(gone, key_col, "left").withColumn(
        "reason", F.when(F.col("_near"), F.lit("near_dup")).otherwise(F.col("reason"))).drop("_near")


def decide(norm: DataFrame, opts: PrepareOptions, key_col: str = "order_key") -> tuple[DataFrame, dict[str, int]]:
    """(key, doc_hash, source, reason) of staged ``judged`` rows, staged, and the counters.

    Only these columns move; near dedup alone reads texts. The counters are observed while the decisions are written, by the
    tasks whose output counts: there is no second pass, and a task that runs again is counted once.
    """
    decided = with_duplicates(norm.select(key_col, "doc_hash", "source", "reason"), key_col)
    reasons = tuple(filters.REASONS)
    if opts.near_dup is not None:
        decided = drop_near_duplicates(stage(decided, "exact-decisions"), norm, opts, key_col)
        reasons = (*reasons, "near_dup")
    seen = Observation("quarry-counters")
    decided = stage(decided.observe(seen, *counters(reasons)), "decisions")
    return decided, {c: seen.get[c] for c in ["seen", "kept", *(f"dropped_{r}" for r in reasons)]}


def places(decided: DataFrame, opts: PrepareOptions, key_col: str = "order_key") -> DataFrame:
    """(key, split, shard, rank) of the kept rows, from their keys and fingerprints alone."""
    kept = kept_rows(decided).select(key_col, "doc_hash", "source")
    split = sampling.holdout_sources(kept, list(opts.holdout_sources), "doc_hash", opts.seed, opts.val_ratio)
    if opts.shard_order == "input":
        placed = sampling.assign_shards_in_order(split, [key_col], opts.shard_size)
    elif opts.shard_order == "shuffled":
        placed = sampling.assign_shards(split, "doc_hash", opts.shard_size, opts.seed)
    else:
        raise ValueError(f"unknown shard_order {opts.shard_order!r}")
    return placed.select(key_col, "split", "shard", "rank")


def run(spark, source: str, output: str, opts: PrepareOptions = PrepareOptions(), lang_model=None,
        fmt: str = "json", glob: str = "*.{json,jsonl}", dry_run: bool = False) -> DataFrame:
    """Prepare a raw JSONL corpus directory into train/val shards; returns the stats row.

    ``source`` is scanned recursively (malformed lines are skipped and not seen);
    kept rows {text, source} are written to ``output/split=<train|val>/shard=<n>/``, or, with ``fmt="files"``, to
    ``output/<train|val>/part-0000.jsonl``. With ``opts.near_dup`` the row has ``dropped_near_dup``, too.
    A dry run or a source that does not exist on its file system returns zero counters without reading anything.

    Reasons, splits, ranks and shards are decided on narrow rows; the texts meet their places in one join and are routed
    to their shards once.
    """
    from pyspark.sql import types as T

    from quarry.sources import jsonl, shard_files, sinks

    if dry_run or not path_exists(spark, source):
        return zero_stats(spark)
    kinds = {f.name: f.dataType for f in jsonl.TEXT_RECORD.fields}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in ("text", "source", *opts.columns)])
    recs = jsonl.scan_jsonl_lenient(spark, source, schema, glob)
    rows = recs.select("order_key", "text", jsonl.default_if_missing("source", "unknown"), *opts.columns)
    norm = judged(rows, opts, key_col="order_key", lang_model=lang_model)
    norm = stage(norm.select("order_key", F.when(F.col("reason").isNull(), F.col("norm_text")).alias("norm_text"), "doc_hash", "source", "reason"),
                 "classified", TEXT_CODEC)
    decided, counted = decide(norm, opts)
    texts = norm.where("reason is null").select("order_key", F.col("norm_text").alias("text"), "source")
    sharded = texts.join(places(decided, opts), "order_key")
    with shuffles_removed(spark):
        if fmt == "files":
            shard_files.write_shard_files(sharded, output)
        else:
            sinks.write_shards(sharded, output, fmt=fmt)
    return spark.createDataFrame([tuple(counted.values())], list(counted))
