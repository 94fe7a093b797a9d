"""Language ID by language-bitmask n-gram filters.

Training counts the character 4-grams of every labelled text by language. An
n-gram belongs to a language when its share of that language's n-grams is at
least ``FLOOR`` and at least ``CONTRAST`` times its greatest share in any
language. The floor bounds a language to 1 / FLOOR n-grams.

All languages share one bit-sliced Bloom filter: an array of ``SLOTS`` rows,
each holding one bit per language (64 languages to a word). The AND of the rows
at an n-gram's ``HASHES`` positions is the set of all languages that contain
it. A text's hits per language are the popcounts of those bits over its
n-grams; the expected false positives, from each language's fill, are taken
off, and the language with the greatest corrected share decides (ties: the
smallest name). ``score`` is that share: the part of the text's n-grams that
the language knows, whatever the number of languages.

Texts are taken whole, lower-cased, with every run of other characters than
letters as one blank. Null text or text without a letter: ``und``, score 0. A
text with letters but without a hit gets the language with the most training
n-grams, score 0. Without any labelled text every prediction is ``und``. A null
doc_id is not trained on and has held_out false. Repeated rows count as often as
they occur. Extra columns are ignored.

The filter's words are built by Spark. ``GROUP`` languages, in the order of their
names, share one filter of SLOTS * 8 bytes for each 64 of them: that is all that
the driver holds and what is broadcast. More languages take one pass over the
texts for each group, and the greatest share of all passes decides.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.registry import fold, fresh, query, table
from quarry.llm.textops import mix
from quarry.operators.sampling import order_rank
from quarry.session import stage

N = 4
SLOTS = 1 << 20
HASHES = 3
FLOOR = 2e-5
CONTRAST = 0.1
GROUP = 512
BLOCK = 1 << 20
FLUSH = 1 << 20

_LETTER = np.zeros(0x110000, dtype=np.int8)  # 0 not asked yet, 1 letter, 2 other


def _letters(codes: np.ndarray) -> np.ndarray:
    kind = _LETTER[codes]
    if (kind == 0).any():
        for c in np.unique(codes[kind == 0]):
            _LETTER[c] = 1 if chr(c).isalpha() else 2
        kind = _LETTER[codes]
    return kind == 1


def gram_hashes(text: str | None) -> np.ndarray:
    """Hashes of the text's 4-grams over letters and single blanks, in blocks of bounded size; empty without a letter."""
    if not text:
        return np.zeros(0, np.uint64)
    out, tail = [], np.array([32], dtype=np.uint64)
    for at in range(0, len(text), BLOCK):
        codes = np.frombuffer(text[at:at + BLOCK].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters(codes)
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # a run of other characters leaves one blank, at its first place
        keep[0] |= tail[-1] != 32
        codes = np.where(letter, codes, 32).astype(np.uint64)[keep]
        if len(codes) and tail[-1] == 32 and codes[0] == 32:
            codes = codes[1:]
        codes = np.concatenate([tail, codes])
        out.append(codes[:-1])
        tail = codes[-1:]  # carried on: the blank before the next block, or its first letter's neighbour
    codes = np.concatenate([*out, tail])
    if not (codes != 32).any():
        return np.zeros(0, np.uint64)
    if codes[-1] != 32:
        codes = np.append(codes, np.uint64(32))
    if len(codes) < N:
        codes = np.append(codes, np.full(N - len(codes), 32, np.uint64))
    h = codes[:len(codes) - N + 1].copy()
    for k in range(1, N):
        h = h * np.uint64(0x110001) + codes[k:len(codes) - N + 1 + k]
    return mix(h)


def _count_batches(batches):
    """(lang, gram, n): counts of a partition, sent on whenever FLUSH distinct n-grams are held."""
    held: dict[str, list] = defaultdict(list)
    size = 0

    def sums():
        for lang, parts in held.items():
            grams, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            grams, where = np.unique(grams, return_inverse=True)
            n = np.bincount(where, weights=n).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)],
                names=["lang", "gram", "n"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            grams, n = np.unique(gram_hashes(text), return_counts=True)
            held[lang].append((grams, n))
            size += len(grams)
            if size >= FLUSH:
                yield from sums()
                held.clear()
                size = 0
    yield from sums()


def positions(grams: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """(HASHES, n) filter positions by double hashing."""
    step = (grams >> np.uint64(32)) | np.uint64(1)
    return np.stack([(grams + np.uint64(i) * step) % np.uint64(slots) for i in range(HASHES)]).astype(np.int64)


class Filters:
    """The bit-sliced filter: ``rows[word, slot]``, one bit per language."""

    def __init__(self, langs: list[str], rows: np.ndarray, totals: list[int]):
        self.langs, self.rows = langs, rows
        fill = np.array([((rows[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(langs))])
        self.false = fill ** HASHES
        self.usual = langs[int(np.argmax(totals))] if totals else "und"

    def hits(self, grams: np.ndarray) -> np.ndarray:
        at = positions(grams, self.rows.shape[1])
        counts = np.zeros(len(self.langs))
        for word, row in enumerate(self.rows):
            mask = row[at[0]] & row[at[1]] & row[at[2]]
            for bit in range(min(64, len(self.langs) - 64 * word)):
                counts[64 * word + bit] = int(((mask >> np.uint64(bit)) & np.uint64(1)).sum())
        return counts

    def best(self, grams: np.ndarray) -> tuple[str | None, float]:
        """The language with the greatest corrected share, and the share; none without a hit."""
        share = np.zeros(len(self.langs))
        for at in range(0, len(grams), BLOCK):
            share += self.hits(grams[at:at + BLOCK])
        share = np.maximum(0.0, (share / len(grams) - self.false) / np.maximum(1e-9, 1 - self.false))
        if share.max() <= 0:
            return None, 0.0
        first = int(np.argmax(share))
        return self.langs[first], float(min(1.0, share[first]))

    def predict(self, text: str | None) -> tuple[str, float]:
        grams = gram_hashes(text)
        if not len(grams) or not self.langs:
            return "und", 0.0
        lang, share = self.best(grams)
        return lang or self.usual, share

    def better(self, text: str | None, lang: str, share: float) -> tuple[str, float]:
        """The answer of this filter where it beats the one of the filters before."""
        grams = gram_hashes(text)
        found, more = self.best(grams) if len(grams) else (None, 0.0)
        return (found, more) if more > share else (lang, share)


def _words(kept: DataFrame) -> DataFrame:
    """(word, slot, bits): the filter's words from (gram, i), gram of language number i."""
    low = F.lit(SLOTS - 1)
    step = F.shiftrightunsigned("gram", 32).bitwiseOR(F.lit(1)).bitwiseAND(low)
    slots = F.array(*[(F.col("gram").bitwiseAND(low) + step * i).bitwiseAND(low) for i in range(HASHES)])
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("i") % 64).cast("int"))
    return kept.select(F.floor(F.col("i") / 64).cast("bigint").alias("word"), F.explode(slots).alias("slot"), bit.alias("bit")).groupBy(
        "word", "slot").agg(F.bit_or("bit").alias("bits"))


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", group: int = GROUP) -> Iterator[Filters]:
    """Filters from every row of ``labelled`` with a language and a text, one for each ``group`` (a multiple of 64) languages."""
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        "lang is not null and text is not null")
    counts = stage(rows.mapInArrow(_count_batches, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")), "lang-grams")
    totals = stage(counts.groupBy("lang").agg(F.sum("n").alias("total")), "lang-totals")
    numbered = stage(totals.join(order_rank(totals, ["lang"], out="i"), "lang"), "lang-numbers")
    shared = counts.join(numbered, "lang").select("gram", "i", (F.col("n") / F.col("total")).alias("share"))
    top = shared.groupBy("gram").agg(F.max("share").alias("top"))
    kept = shared.where(F.col("share") >= FLOOR).join(top, "gram").where(F.col("share") >= CONTRAST * F.col("top"))
    words = stage(_words(kept.select("gram", "i")), "lang-words")
    usual = numbered.agg(F.max(F.struct("total", -F.col("i"), "lang")).alias("m")).first().m
    for first in range(0, max(1, numbered.count()), group):
        held = numbered.where(F.col("i").between(first, first + group - 1)).orderBy("i").collect()  # ``group`` rows at most
        bits = np.zeros((max(1, -(-len(held) // 64)), SLOTS), dtype=np.uint64)
        mine = words.where(F.col("word").between(first // 64, first // 64 + len(bits) - 1)).toArrow()  # SLOTS rows a word at most
        word, slot, value = (mine.column(c).to_numpy() for c in ("word", "slot", "bits"))
        bits[word.astype(np.int64) - first // 64, slot.astype(np.int64)] = value.astype(np.int64).view(np.uint64)
        found = Filters([r.lang for r in held], bits, [r.total for r in held])
        if usual is not None:
            found.usual = usual.lang
        yield found


def _pass(docs: DataFrame, filters: Filters, text_col: str, pred_col: str, score_col: str, first: bool) -> DataFrame:
    """``docs`` with the prediction of one filter, or with the better one of it and the columns' own."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    schema = docs.select("*", F.lit("").alias(pred_col), F.lit(0.0).alias(score_col)).schema if first else docs.schema

    def apply(batches):
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            if first:
                columns, names = list(batch.columns), list(batch.schema.names)
                found = [shared.value.predict(t) for t in texts]
            else:
                columns, names = list(batch.columns[:-2]), list(batch.schema.names[:-2])
                found = [shared.value.better(*row) for row in zip(texts, batch.column(pred_col).to_pylist(), batch.column(score_col).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*names, pred_col, score_col])

    return docs.mapInArrow(apply, schema)


def predict(docs: DataFrame, filters: Iterable[Filters], text_col: str = "text", pred_col: str = "lang_pred",
            score_col: str = "score") -> DataFrame:
    """``docs`` with a predicted language and its score in two more columns."""
    for at, each in enumerate(filters):
        if at:
            docs = stage(docs, "lang-pass")  # the filter of the pass before is no longer needed
        docs = _pass(docs, each, text_col, pred_col, score_col, at == 0)
    return docs


def identify(docs: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, lang_pred, score), trained on the rows whose fold is not 2."""
    filters = train(docs.where(fold(key_col) != 2))
    rows = docs.select(F.col(key_col).alias("doc_id"), "text", F.coalesce(fold(key_col) == 2, F.lit(False)).alias("held_out"))
    return predict(rows, filters).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.3, key_col: str = "doc_id") -> DataFrame:
    """``docs`` without those of no language: no letter, or surely under ``least`` of the n-grams known to any language.

    The share of a short text is an estimate from few n-grams: two standard
    errors (at most 1 / sqrt of their number) are given to it.
    """
    filters = train(docs.where(fold(key_col) != 2))
    pred, known = fresh(docs, "_pred"), fresh(docs, "_known")
    rows = predict(docs, filters, pred_col=pred, score_col=known)
    likely = F.col(known) + 1 / F.sqrt(F.greatest(F.length("text"), F.lit(1)))
    return rows.where((F.col(pred) != "und") & (likely >= least)).drop(pred, known)


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
