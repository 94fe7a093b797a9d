"""Language identification: character-trigram naive Bayes, trained and applied in Spark.

Model (add-one smoothing, integer micro-nats so sums are exact in any order):
  lp(lang, g) = round(ln((count(lang, g) + 1) / (total(lang) + V)) * 1e6)
  lp0(lang)   = round(ln(1 / (total(lang) + V)) * 1e6)          (gram unseen in lang)
V = number of distinct grams in training. Grams unseen in every language are
ignored. A document's score for a language is
  sum over its known grams g (k occurrences) of k * lp(lang, g), with lp0 for unseen pairs
      = n_known * lp0(lang) + sum k * (lp(lang, g) - lp0(lang)) over seen pairs,
so the (lang x gram) grid is never materialized. The label is the arg-max
(ties -> larger label), its score the softmax posterior over languages.

Texts are scored whole (lower-cased). The posterior saturates near 1 on long
text: use it for a gate, not for ranking.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.shingle_arrays import text_slices
from quarry.session import stage

NGRAM = 3
MICRO = 1_000_000
MODEL_CELLS = 8_000_000
BLOCK = 1 << 20
TABLE = 1 << 24
HELD = 1 << 20


def read_text(c: Column) -> Column:
    """The text whose n-grams count: lower-cased, newlines as spaces."""
    return F.lower(F.regexp_replace(c, "\n", " "))


def grams(c: Column, n: int = NGRAM) -> Column:
    """Overlapping character n-grams of the lower-cased text (newlines read as spaces)."""
    return F.regexp_extract_all(read_text(c), F.lit(f"(?s)(?=([^\\x{{D800}}-\\x{{DFFF}}].{{{n - 1}}}))"), 1)


def _gram_text(packed: np.ndarray) -> pa.Array:
    """The grams of packed code points."""
    codes = np.stack([packed >> 42, packed >> 21 & 0x1FFFFF, packed & 0x1FFFFF], axis=1).astype(np.uint32)
    text = codes.tobytes().decode("utf-32-le", "replace")
    return pa.array([text[i:i + NGRAM] for i in range(0, len(text), NGRAM)], pa.string())


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal keys added up, sorted by key."""
    joined, m = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(joined)
    joined, m = joined[order], m[order]
    first = np.flatnonzero(np.concatenate([[True], joined[1:] != joined[:-1]]))
    return joined[first], np.add.reduceat(m, first)


def _count_batches(held: int):
    """(lang, gram, m): the grams of a task's texts, counted there up to ``held`` different ones at a time."""
    def given(counted, kind):
        for label, (keys, m) in counted.items():
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(label, kind), len(keys)), _gram_text(keys), pa.array(m)], names=["lang", "gram", "m"])

    def count(batches):
        counted, kind = {}, None
        for batch in batches:
            kind = batch.column("lang").type
            labels = batch.column("lang").to_pylist()
            for lo, hi, texts in text_slices(batch.column("_t"), BLOCK):
                by = {}
                for label, text in zip(labels[lo:hi], texts):
                    if len(text) >= NGRAM:
                        by.setdefault(label, []).append(_packed(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)))
                for label, parts in by.items():
                    keys, m = np.unique(np.concatenate(parts), return_counts=True)
                    old = counted.get(label)
                    counted[label] = (keys, m.astype(np.int64)) if old is None else _summed([old[0], keys], [old[1], m.astype(np.int64)])
                if sum(len(keys) for keys, _ in counted.values()) > held:
                    yield from given(counted, kind)
                    counted = {}
        yield from given(counted, kind)
    return count


def train(df: DataFrame, text_col: str = "text", label_col: str = "lang", held: int = HELD) -> tuple[DataFrame, DataFrame]:
    """Returns (model, priors): model(lang, gram, lp, delta) for seen pairs, priors(lang, lp0)."""
    rows = df.where(F.col(label_col).isNotNull()).select(F.col(label_col).alias("lang"), read_text(F.col(text_col)).alias("_t")).where("_t is not null")
    schema = rows.select("lang", F.lit("").alias("gram"), F.lit(0).cast("bigint").alias("m")).schema
    # (lang, gram, count) is small next to the text and feeds totals, V and lp: compute it once
    counts = stage(rows.mapInArrow(_count_batches(held), schema).groupBy("lang", "gram").agg(F.sum("m").alias("count")), "langid-counts")
    totals = counts.groupBy("lang").agg(F.sum("count").alias("total"))  # one row per language
    v = counts.select(F.countDistinct("gram")).scalar()
    priors = totals.select("lang", F.round(F.log(F.lit(1.0) / (F.col("total") + v)) * MICRO).cast("bigint").alias("lp0"),
                           "total")
    model = counts.join(F.broadcast(priors), on="lang").select(
        "lang", "gram",
        F.round(F.log((F.col("count") + 1) / (F.col("total") + v)) * MICRO).cast("bigint").alias("lp"),
        "lp0",
    ).withColumn("delta", F.col("lp") - F.col("lp0")).drop("lp0")
    # the model is an artifact read by every scoring job: materialize it once
    return stage(model, "langid-model"), stage(priors.drop("total"), "langid-priors")


def _packed(codes: np.ndarray) -> np.ndarray:
    """Each run of three code points as one number."""
    c = codes.astype(np.int64)
    return c[:-2] << 42 | c[1:-1] << 21 | c[2:]


class _Places:
    """Places of grams in a sorted array of packed grams.

    Code points that no gram has become letter 0. With an alphabet of A letters and A ** 3 up to ``TABLE``, a gram is looked up in
    a table; with more by a search.
    """

    def __init__(self, grams: np.ndarray):
        self.grams = grams
        letters = np.unique(np.concatenate([grams >> 42, grams >> 21 & 0x1FFFFF, grams & 0x1FFFFF]))
        self.size, self.table = len(letters) + 1, None
        if self.size ** NGRAM <= TABLE:
            self.letter = np.zeros(0x110000, dtype=np.int32)
            self.letter[letters] = np.arange(1, self.size)
            self.table = np.full(self.size ** NGRAM, -1, dtype=np.int32)
            self.table[self._cells(*(self.letter[x] for x in (grams >> 42, grams >> 21 & 0x1FFFFF, grams & 0x1FFFFF)))] = np.arange(len(grams))

    def _cells(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (a * np.int32(self.size) + b) * np.int32(self.size) + c

    def of(self, codes: np.ndarray) -> np.ndarray:
        """Places of the known grams of a run of code points."""
        if self.table is not None:
            x = self.letter[codes]
            place = self.table[self._cells(x[:-2], x[1:-1], x[2:])]
            return place[place >= 0]
        found = _packed(codes)
        place = np.minimum(np.searchsorted(self.grams, found), len(self.grams) - 1)
        return place[self.grams[place] == found]


def _text_sums(text: str, places: _Places, deltas: np.ndarray) -> tuple[int, np.ndarray]:
    """(known grams, sum of deltas by language) of one lower-cased text, in blocks of bounded size."""
    known, sums = 0, np.zeros(deltas.shape[1], dtype=np.int64)
    for at in range(0, len(text) - NGRAM + 1, BLOCK):
        place = places.of(np.frombuffer(text[at:at + BLOCK + NGRAM - 1].encode("utf-32-le"), dtype=np.uint32))
        known += len(place)
        sums += deltas[place].sum(axis=0)
    return known, sums


def _sums_looked_up(df: DataFrame, dense: DataFrame, n_langs: int, text_col: str, key_col: str) -> DataFrame:
    """(key, _nk, _s0, ...) by a lookup in the broadcast model: no gram is shuffled, one text is held at a time."""
    held = dense.toArrow()
    packed = np.array([_packed(np.frombuffer(g.encode("utf-32-le"), dtype=np.uint32))[0] for g in held.column("gram").to_pylist()], dtype=np.int64)
    order = np.argsort(packed)
    deltas = np.array(held.column("d").to_pylist(), dtype=np.int64).reshape(len(packed), n_langs)[order]
    shared = df.sparkSession.sparkContext.broadcast((packed[order], deltas))
    rows = df.select(key_col, read_text(F.col(text_col)).alias("_t")).where("_t is not null")
    names = ["_nk", *(f"_s{i}" for i in range(n_langs))]
    schema = rows.select(key_col, *[F.lit(0).cast("bigint").alias(c) for c in names]).schema

    def look_up(batches):
        grams, deltas = shared.value
        places = _Places(grams) if len(grams) else None
        for batch in batches:
            out = np.zeros((len(names), batch.num_rows), dtype=np.int64)
            for row, text in enumerate(batch.column("_t")):
                if len(grams):
                    out[0, row], out[1:, row] = _text_sums(text.as_py(), places, deltas)
            found = pa.RecordBatch.from_arrays([batch.column(key_col), *map(pa.array, out)], names=[key_col, *names])
            yield found.filter(pa.array(out[0] > 0))

    return rows.mapInArrow(look_up, schema)


def _sums_joined(df: DataFrame, dense: DataFrame, n_langs: int, text_col: str, key_col: str) -> DataFrame:
    """The same by a join, for a model too large to broadcast."""
    # per (doc, gram) occurrence counts: partial aggregation is local to each document's partition
    occ = df.select(key_col, F.explode(grams(F.col(text_col))).alias("gram")).groupBy(key_col, "gram").agg(
        F.count(F.lit(1)).alias("k"))
    return occ.join(dense, "gram").groupBy(key_col).agg(
        F.sum("k").alias("_nk"), *[F.sum(F.col("k") * F.col("d")[i]).alias(f"_s{i}") for i in range(n_langs)])


def score(df: DataFrame, model: tuple[DataFrame, DataFrame], text_col: str = "text", key_col: str = "doc_id",
          label_col: str = "label", score_col: str = "score", langs: list[str] | None = None,
          model_cells: int = MODEL_CELLS) -> DataFrame:
    """(key, label, score) for every row whose text has at least one known gram. Keys are unique.

    A model of at most ``model_cells`` numbers (grams by languages, counted; 8 bytes each) is broadcast, a larger one joined.
    """
    lp_model, priors = model
    # the label set is model metadata (a few hundred values at most)
    lp0 = {r[0]: r[1] for r in priors.collect()}
    if langs is None:
        langs = sorted(lp0)
    dense = lp_model.groupBy("gram").pivot("lang", langs).agg(F.first("delta"))
    dense = stage(dense.select("gram", F.array(*[F.coalesce(F.col(f"`{l}`"), F.lit(0)) for l in langs]).alias("d")), "langid-dense")
    small = dense.count() * max(1, len(langs)) <= model_cells
    sums = (_sums_looked_up if small else _sums_joined)(df, dense, len(langs), text_col, key_col)
    scores = [F.col("_nk") * F.lit(lp0[l]) + F.col(f"_s{i}") for i, l in enumerate(langs)]
    per = sums.select(key_col, F.array(*[F.struct(s.alias("s"), F.lit(l).alias("l")) for s, l in zip(scores, langs)]).alias("_a"))
    best = F.array_max("_a")
    mx = best["s"]
    z = F.aggregate("_a", F.lit(0.0), lambda acc, x: acc + F.exp((x["s"] - mx) / F.lit(float(MICRO))))
    return per.select(key_col, best["l"].alias(label_col), (F.lit(1.0) / z).alias(score_col))


def with_scores(df: DataFrame, model, text_col: str = "text", key_col: str = "doc_id", label_col: str = "label",
                score_col: str = "score") -> DataFrame:
    """``df`` plus (label, score); rows without a known gram get nulls (and fail any gate)."""
    return df.join(score(df, model, text_col, key_col, label_col, score_col), on=key_col, how="left")
