"""Operator options with the reference defaults."""

from __future__ import annotations

from dataclasses import dataclass

from quarry.operators.plugins import Plugin


@dataclass(frozen=True)
class NearDupOptions:
    # 5-gram character shingles, Jaccard 0.8.
    ngram: int = 5
    threshold: float = 0.8
    num_perm: int = 64
    bands: int = 16
    rows_per_band: int = 4
    seed: int = 42


@dataclass(frozen=True)
class PrepareOptions:
    # Defaults of the corpus-preparation stage.
    min_chars: int = 200
    max_chars: int = 200_000
    lang: str = "pl"
    lang_min_score: float = 0.9
    val_ratio: float = 0.05
    shard_size: int = 50_000
    seed: int = 42
    # Language gate. None = no scorer given: the gate keeps everything, which is
    # what the reference does when no language model is supplied.
    lang_scorer: str | Plugin | None = None  # None | "columns" | "ngram" | a user's scorer
    lang_col: str = "lang"
    lang_score_col: str | None = None
    # Planned steps, off unless asked for.
    fix_mojibake: bool = False  # repair texts before they are normalized
    near_dup: NearDupOptions | None = None  # after exact dedup: the first document of a near-duplicate cluster stays
    holdout_sources: tuple[str, ...] = ()  # sources that go to val as a whole
    shard_order: str = "shuffled"  # or "input": shards in path and line order
    columns: tuple[str, ...] = ()  # further columns of the files that a gate reads ("lang", "lang_score")


@dataclass(frozen=True)
class PackOptions:
    # Fixed value: sequence length 4096 of the fine-tuning config.
    seq_len: int = 4096
    buckets: int = 64
    seed: int = 42
    vocab_size: int = 32_000
    add_bos: bool = False
    keep_partial: bool = True
