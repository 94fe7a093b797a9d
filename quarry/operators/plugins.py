"""User models on whole texts: language scorers and tokenizers, applied in Arrow batches.

A ``Plugin`` names a function without arguments that loads the model. It is called
once in every Python worker, where the model stays for later tasks. The model is a
function of an Arrow array of strings (no nulls, about ``SLICE`` bytes at a time)
that returns, one for each text,

* a scorer: two arrays, labels (string) and scores (double; null: no answer);
* a tokenizer: a list of token ids (int) for each text.

Results of another length or type fail the job with a message that names the
plug-in. Only the text goes to Python; a null text is given to no model.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = 1 << 22
HELD = 4  # models that a worker keeps

SCORE_TYPE = T.StructType([T.StructField("label", T.StringType()), T.StructField("score", T.DoubleType())])
IDS_TYPE = T.ArrayType(T.IntegerType())

_MODELS: dict[str, Callable] = {}


@dataclass(frozen=True)
class Plugin:
    """A model to load in the workers; ``key`` tells one plug-in's model from another's."""

    load: Callable[[], Callable]
    name: str = "plug-in"
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def model_of(plugin: Plugin) -> Callable:
    """The plug-in's model, loaded on its first use in this process."""
    if plugin.key not in _MODELS:
        while len(_MODELS) >= HELD:
            _MODELS.pop(next(iter(_MODELS)))
        _MODELS[plugin.key] = plugin.load()
    return _MODELS[plugin.key]


def slices(texts: pa.Array, limit: int = SLICE) -> Iterator[pa.Array]:
    """Runs of rows of about ``limit`` bytes; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(texts):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield texts.slice(lo, hi - lo)
        lo = hi


def _checked(found, kind: pa.DataType, n: int, what: str) -> pa.Array:
    try:
        found = found if isinstance(found, pa.Array) else pa.array(found, from_pandas=True)
        found = found.cast(kind)
    except (pa.ArrowException, TypeError) as e:
        raise ValueError(f"{what} must be {kind}: {e}") from e
    if len(found) != n:
        raise ValueError(f"{len(found)} {what} for {n} texts")
    return found


def _scores(plugin: Plugin, found, n: int) -> pa.Array:
    try:
        labels, scores = found
    except (TypeError, ValueError) as e:
        raise ValueError(f"{plugin.name} must return labels and scores") from e
    return pa.StructArray.from_arrays([_checked(labels, pa.string(), n, f"labels of {plugin.name}"),
                                       _checked(scores, pa.float64(), n, f"scores of {plugin.name}")], names=["label", "score"])


def _ids(plugin: Plugin, found, n: int) -> pa.Array:
    ids = _checked(found, pa.list_(pa.int32()), n, f"token ids of {plugin.name}")
    if ids.null_count or ids.flatten().null_count:
        raise ValueError(f"null among the token ids of {plugin.name}")
    return ids


def _answers(plugin: Plugin, texts: pa.Array, check: Callable, kind: pa.DataType) -> pa.Array:
    """The model's checked answers, null for null texts."""
    parts = []
    for part in slices(texts):
        given = part.drop_null()
        if not len(given):
            parts.append(pa.nulls(len(part), kind))
            continue
        answers = check(plugin, model_of(plugin)(given), len(given)).cast(kind)
        known = part.is_valid().to_numpy(zero_copy_only=False)
        parts.append(answers.take(pa.array(np.cumsum(known) - 1, mask=~known)))
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


_SCORE_ARROW = pa.struct([("label", pa.string()), ("score", pa.float64())])
_IDS_ARROW = pa.list_(pa.int32())


def scored(plugin: Plugin, text: Column) -> Column:
    """Struct (label, score) of a scorer's answer; null for a null text."""
    @F.arrow_udf(returnType=SCORE_TYPE)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield _answers(plugin, texts, _scores, _SCORE_ARROW)
    return score(text)


def token_ids(plugin: Plugin, text: Column) -> Column:
    """array<int> of a tokenizer's ids; empty for a null text."""
    @F.arrow_udf(returnType=IDS_TYPE)
    def tokenize(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield _answers(plugin, texts, _ids, _IDS_ARROW)
    return F.coalesce(tokenize(text), F.array().cast("array<int>"))
