"""Toxicity: a support vector machine on a subsequence string kernel, with Nystroem landmarks.

The kernel of two tokens sums, over all 3-character subsequences that span at
most ``SPAN`` characters, the product of their weights ``LAMBDA ** span``, and is
normalized and raised to ``POWER``. Gaps and inserted characters so lower a
match instead of losing it. Tokens are whitespace words, lower-cased, reduced to
letters and digits; three or more single characters in a row are one token.
Sentences end at ``.``, ``!``, ``?`` before a blank, and at line feeds; what
counts in a sentence is its most toxic token, so long sentences gather no noise.

A label belongs to a document of many sentences, so the labels are first carried
to tokens: by log odds between toxic and clean documents (less two standard
errors; at least ``LEAST_ODDS``), weighted with the toxic documents that hold the
token, each toxic document names as witnesses its tokens of at least
``NEAR_BEST`` of its best weight. The machine learns witnesses against other
tokens of clean documents, in ``ROUNDS`` that each add the ``CLEAN_TOKENS`` it
found most toxic. Landmarks are the ``LANDMARKS`` most named witnesses, and in
each round the most frequent of those clean tokens; the Nystroem map of the
landmarks' own kernel matrix makes the machine linear: ``v . k(token,
landmarks)``. A document's margin is that of its most toxic sentence; Platt's
sigmoid makes it a score from 0 to 1.

Training takes at most ``SAMPLE`` rows of either label, those with the smallest
hashed ids: a bounded sample of labelled rows. Each stands for labelled ids of
its label / sampled ones in the machine's costs and in Platt's sigmoid, so a
score means the same whether or not the bound is met. Scoring reads every whole text.
Only the model is broadcast; its size is bounded by ``LANDMARKS`` and their
length.

Null or empty texts score as the empty sentence. Without rows of both labels
every score is 0. A label row is used once per doc_id (the greatest label
counts); null labels and ids are not trained on. A null doc_id has held_out
false. Repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.registry import fold, query, table
from quarry.llm.textops import mix
from quarry.session import stage

SPAN, LAMBDA, POWER = 6, 0.6, 4
LANDMARKS = 192
LONGEST_LANDMARK = 24
SAMPLE = 3000
WITNESSES = 5000
NEAR_BEST, LEAST_ODDS = 0.3, 0.7
CLEAN_TOKENS = 4000
ROUNDS = 3
RIDGE = 0.3
CUT = 0.3
CACHE = 600_000  # token weights that a task keeps
TEXTS = 1 << 21  # characters of texts whose tokens are scored together
CHUNK = 1 << 20  # features in hand at once
LONG = 1 << 16  # tokens of more characters are hashed in blocks
SIEVE_BITS = 22

_STEPS = [(j, k) for k in range(2, SPAN) for j in range(1, k)]
_WEIGHTS = np.array([LAMBDA ** (k + 1) for _, k in _STEPS])
_APART = re.compile(r"(?<!\S)\w(?:\s\w){2,}(?!\S)")


def clean(token: str) -> str:
    return token if token.isalnum() else "".join(c for c in token if c.isalnum())


def sentences(text: str | None) -> list[list[str]]:
    """The raw tokens of each sentence of the lower-cased text."""
    out = []
    for line in (text or "").lower().split("\n"):
        line = _APART.sub(lambda m: "".join(m[0].split()), line)
        tokens, start = line.split(), 0
        for i, t in enumerate(tokens):
            if t[-1] in ".!?":
                out.append(tokens[start:i + 1])
                start = i + 1
        if start < len(tokens):
            out.append(tokens[start:])
    return out


def bag(text: str | None) -> set[str]:
    """The distinct raw tokens of all sentences of the text."""
    out: set[str] = set()
    for line in (text or "").lower().split("\n"):
        out.update(_APART.sub(lambda m: "".join(m[0].split()), line).split())
    return out


def features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subsequence hashes and weights of tokens of one length: codes (tokens, length) -> (tokens, features)."""
    n, length = codes.shape
    parts, weights = [], []
    for (j, k), w in zip(_STEPS, _WEIGHTS):
        if k < length:
            m = length - k
            parts.append(mix((codes[:, :m] * np.uint64(0x110001) + codes[:, j:j + m]) * np.uint64(0x110003) + codes[:, k:k + m]))
            weights.append(np.full(m, w))
    if not parts:
        return np.zeros((n, 0), np.uint64), np.zeros(0)
    return np.concatenate(parts, axis=1), np.concatenate(weights)


def self_kernel(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    order = np.argsort(hashes, axis=1)
    h, w = np.take_along_axis(hashes, order, 1), weights[order]
    new = np.ones(h.shape, dtype=bool)
    new[:, 1:] = h[:, 1:] != h[:, :-1]
    sums = np.add.reduceat(w.ravel(), np.flatnonzero(new.ravel()))
    return np.add.reduceat(sums ** 2, np.concatenate([[0], np.cumsum(new.sum(axis=1))[:-1]]))


def _blocks(codes: np.ndarray):
    """(hashes, weights) of one token's subsequences, by blocks of first characters."""
    step = CHUNK // len(_STEPS)
    for (j, k), w in zip(_STEPS, _WEIGHTS):
        for lo in range(0, len(codes) - k, step):
            a = codes[lo:min(lo + step, len(codes) - k)]
            h = (a * np.uint64(0x110001) + codes[lo + j:lo + j + len(a)]) * np.uint64(0x110003) + codes[lo + k:lo + k + len(a)]
            yield mix(h), w


def long_self_kernel(codes: np.ndarray) -> float:
    """The self kernel of one long token, summed over parts of the hash space of about 16 * CHUNK features each."""
    parts, total = max(1, len(codes) * len(_STEPS) // (CHUNK * 16)), 0.0
    for part in range(parts):
        held = [(h[h % np.uint64(parts) == part], w) for h, w in _blocks(codes)]
        hashes, at = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        sums = np.bincount(at, np.concatenate([np.full(len(h), w) for h, w in held]), len(hashes))
        total += float((sums ** 2).sum())
    return total


class Landmarks:
    """The kernel of tokens with a fixed list of landmark tokens."""

    def __init__(self, tokens: list[str]):
        self.tokens = tokens
        hashes, columns, values, norms = [], [], [], []
        for i, t in enumerate(tokens):
            h, w = features(np.array([[ord(c) for c in t]], dtype=np.uint64))
            norms.append(float(self_kernel(h, w)[0]))
            hashes.append(h[0]), values.append(w), columns.append(np.full(h.shape[1], i))
        self.known, at = np.unique(np.concatenate(hashes), return_inverse=True)
        # of each known subsequence, the landmarks that have it, one after another
        order = np.argsort(at, kind="stable")
        self.columns, self.values = np.concatenate(columns)[order], np.concatenate(values)[order]
        self.counts = np.bincount(at, minlength=len(self.known))
        self.starts = np.cumsum(self.counts) - self.counts
        self.norms = np.sqrt(np.array(norms))
        self.sieve = np.zeros(1 << SIEVE_BITS, dtype=bool)  # by the last bits of a hash: whether one of the known has them
        self.sieve[self.known & np.uint64(len(self.sieve) - 1)] = True

    def _known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in the flat ``hashes``, numbers of the known subsequences there)."""
        flat = hashes.ravel()
        where = np.flatnonzero(self.sieve[flat & np.uint64(len(self.sieve) - 1)])
        at = np.minimum(np.searchsorted(self.known, flat[where]), len(self.known) - 1)
        same = self.known[at] == flat[where]
        return where[same], at[same]

    def _long(self, codes: np.ndarray) -> np.ndarray:
        """The kernel of one token of any length."""
        both = np.zeros(len(self.tokens))
        for hashes, w in _blocks(codes):
            for code, times in zip(*np.unique(self._known(hashes)[1], return_counts=True)):
                own = slice(self.starts[code], self.starts[code] + self.counts[code])
                np.add.at(both, self.columns[own], self.values[own] * (w * times))
        return np.minimum(1.0, both / (np.sqrt(long_self_kernel(codes)) * self.norms)) ** POWER

    def kernel(self, tokens: list[str]) -> np.ndarray:
        """(tokens, landmarks) in [0, 1]; tokens under three characters have no subsequence and give 0."""
        out = np.zeros((len(tokens), len(self.tokens)))
        by_length: dict[int, list[int]] = {}
        for i, t in enumerate(tokens):
            if len(t) > 2:
                by_length.setdefault(len(t), []).append(i)
        for length, where in by_length.items():
            step = max(1, CHUNK // (length * len(_STEPS) * 16))
            for lo in range(0, len(where), step):
                part = where[lo:lo + step]
                codes = np.frombuffer("".join([tokens[i] for i in part]).encode("utf-32-le", "surrogatepass"), np.uint32)
                if length > LONG:
                    out[part[0]] = self._long(codes.astype(np.uint64))
                    continue
                hashes, weights = features(codes.astype(np.uint64).reshape(len(part), length))
                where_known, code = self._known(hashes)
                if len(code):
                    row, col = np.divmod(where_known, hashes.shape[1])
                    hit, row = np.unique(row, return_inverse=True)
                    times = self.counts[code]
                    entry = np.arange(times.sum()) + np.repeat(self.starts[code] - (np.cumsum(times) - times), times)
                    cell = np.repeat(row * len(self.tokens), times) + self.columns[entry]
                    both = np.bincount(cell, self.values[entry] * np.repeat(weights[col], times),
                                       len(hit) * len(self.tokens)).reshape(len(hit), -1)
                    norm = np.sqrt(self_kernel(hashes[hit], weights))
                    like = np.minimum(1.0, both / (norm[:, None] * self.norms))
                    powered = like
                    for _ in range(POWER - 1):  # several times as fast as ** on arrays
                        powered = powered * like
                    out[np.array(part)[hit]] = powered
        return out


class Model:
    """Margins of sentences: bias + the greatest v . k(token, landmarks) of their tokens."""

    def __init__(self, landmarks: Landmarks, v: np.ndarray, bias: float, platt: tuple[float, float] = (1.0, 0.0)):
        self.landmarks, self.v, self.bias, self.platt = landmarks, v, bias, platt
        self.cache: dict[str, float] = {}

    def __reduce__(self):
        return Model, (self.landmarks, self.v, self.bias, self.platt)

    def _learn(self, raw: set[str]) -> None:
        """Weights of tokens that the cache lacks; tokens that are the same once cleaned are scored once."""
        if len(self.cache) + len(raw) > CACHE:
            self.cache.clear()
        missing: dict[str, list[str]] = {}
        for t in raw:
            if t not in self.cache:
                missing.setdefault(clean(t), []).append(t)
        cleaned = list(missing)
        for lo in range(0, len(cleaned), 4096):
            part = cleaned[lo:lo + 4096]
            for c, weight in zip(part, (self.landmarks.kernel(part) @ self.v).tolist()):
                self.cache.update(dict.fromkeys(missing[c], weight))

    def margins(self, texts: list[str | None]) -> list[float]:
        """The margin of every text's most toxic sentence, which is that of its most toxic token.

        The tokens of about ``TEXTS`` characters of texts are scored at a time.
        """
        out, held, size = [], [], 0
        for i, text in enumerate(texts):
            held.append(bag(text))
            size += len(text or "")
            if size >= TEXTS or i == len(texts) - 1:
                self._learn(set().union(*held))
                get = self.cache.__getitem__
                out += [max(map(get, own), default=0.0) + self.bias for own in held]
                held, size = [], 0
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        a, b = self.platt
        return 1 / (1 + np.exp(-np.clip(a * np.array(self.margins(texts), dtype=float) + b, -50, 50)))

    def score(self, text: str | None) -> float:
        return float(self.scores([text])[0])


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights of the squared-hinge linear machine (Newton steps on the rows inside the margin); y is -1 or 1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, hold = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    hold[-1, -1] = 1e-6
    inside = None
    for _ in range(100):
        now = y * (x @ w) < 1
        if inside is not None and (now == inside).all():
            break
        inside = now
        part = x[inside] * cost[inside, None]
        new = np.linalg.solve(part.T @ x[inside] + hold, part.T @ y[inside])
        w = new if not w.any() else (w + new) / 2 if _ > 20 else new
    return w


def _platt(margin: np.ndarray, y: np.ndarray, stands: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic fit with Platt's smoothed targets; a row counts ``stands`` times."""
    pos, neg = stands[y > 0].sum(), stands[y < 0].sum()
    goal = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, ab = np.stack([margin, np.ones(len(y))], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        step = np.linalg.solve((x * (stands * (p * (1 - p) + 1e-9))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (stands * (p - goal)))
        ab = ab - np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    return float(ab[0]), float(ab[1])


def _token_batches(batches):
    """(token, toxic): the distinct cleaned tokens of each text."""
    for batch in batches:
        tokens, labels = [], []
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            own = {clean(t) for t in bag(text)}
            own = [t for t in own if 3 <= len(t) <= LONGEST_LANDMARK]
            tokens += own
            labels += [toxic] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.string()), pa.array(labels, pa.int32())], names=["token", "toxic"])


def _witness_batches(weights):
    """(token): the tokens of each text whose weight comes near its best one."""
    def witness(batches):
        get = weights.value.get
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                own = {t: get(t, 0.0) for t in {clean(t) for t in bag(text)}}
                best = max(own.values(), default=0.0)
                out += [t for t, w in own.items() if best > 0 and w >= NEAR_BEST * best]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["token"])
    return witness


def _hardness_batches(model):
    """(token, clean, margin) of cleaned tokens."""
    def hardness(batches):
        for batch in batches:
            tokens, m = batch.column("token").to_pylist(), model.value
            margins = [m.landmarks.kernel(tokens[i:i + 4096]) @ m.v for i in range(0, len(tokens), 4096)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("token"), batch.column("clean"), pa.array(np.concatenate(margins or [np.zeros(0)]))],
                names=["token", "clean", "margin"])
    return hardness


def _margin_batches(model):
    def margin(batches):
        for batch in batches:
            found = model.value.margins(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.float64())], names=["toxic", "margin"])
    return margin


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> Model | None:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); None without both labels."""
    spark = docs.sparkSession
    labels = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    labels = stage(labels, "toxic-labels")
    chosen = [labels.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for t in (0, 1)]
    chosen = stage(chosen[0].union(chosen[1]), "toxic-ids")
    rows = docs.join(F.broadcast(chosen), "doc_id").select("text", "toxic")  # at most 2 * sample ids
    rows = stage(rows.dropDuplicates().repartition(spark.sparkContext.defaultParallelism), "toxic-sample")
    sizes = dict(rows.groupBy("toxic").count().collect())
    if not sizes.get(0) or not sizes.get(1):
        return None
    taken = dict(chosen.groupBy("toxic").count().collect())
    stands = {t: n / taken[t] for t, n in labels.groupBy("toxic").count().collect() if t in taken}
    share = spark.sparkContext.broadcast
    pos, neg = F.sum("toxic"), F.sum(1 - F.col("toxic"))
    odds = F.log((pos + 0.5) / (sizes[1] + 1)) - F.log((neg + 0.5) / (sizes[0] + 1)) - 2 * F.sqrt(
        1 / (pos + 0.5) + 1 / (neg + 0.5))
    tokens = stage(rows.mapInArrow(_token_batches, "token string, toxic int").groupBy("token").agg(
        odds.alias("odds"), (odds * pos).alias("weight"), neg.alias("clean")), "toxic-tokens")
    top = tokens.where(F.col("odds") >= LEAST_ODDS).orderBy(F.desc("weight"), "token").limit(WITNESSES).collect()
    named = rows.where("toxic = 1").mapInArrow(_witness_batches(share({r.token: r.weight for r in top})), "token string")
    named = named.groupBy("token").count().orderBy(F.desc("count"), "token").collect()  # at most WITNESSES rows
    if not named:
        return None
    witnesses = spark.createDataFrame([(r.token,) for r in named], "token string")
    clean_tokens = tokens.where("clean > 0").join(F.broadcast(witnesses), "token", "left_anti").select("token", "clean")
    weight = stands[1] * np.array([float(r["count"]) for r in named])
    against: dict[str, int] = {}
    marks = Landmarks([r.token for r in named[:landmarks]])
    model = Model(marks, np.ones(len(marks.tokens)), 0.0)  # the first round looks for what is like any landmark
    for _ in range(ROUNDS):
        hard = clean_tokens.mapInArrow(_hardness_batches(share(model)), "token string, clean bigint, margin double")
        hard = hard.orderBy(F.desc("margin"), "token").limit(CLEAN_TOKENS).collect()
        against |= {r.token: r.clean for r in hard}
        # the frequent ones of the clean tokens that look toxic become landmarks too
        common = sorted((r for r in hard if len(r.token) > 2), key=lambda r: (-r.clean * max(0.0, r.margin + 1), r.token))
        marks = Landmarks(list(dict.fromkeys([*marks.tokens, *(r.token for r in common[:landmarks // 8])])))
        values, vectors = np.linalg.eigh(marks.kernel(marks.tokens))
        kept = values > 1e-6 * values.max()
        nystroem = (vectors[:, kept] / np.sqrt(values[kept])) @ vectors[:, kept].T
        x = marks.kernel([r.token for r in named] + list(against)) @ nystroem
        y = np.array([1.0] * len(named) + [-1.0] * len(against))
        w = _machine(x, y, np.concatenate([weight, stands[0] * np.array(list(against.values()), dtype=float)]))
        model = Model(marks, nystroem @ w[:-1], float(w[-1]))
    found = rows.mapInArrow(_margin_batches(share(model)), "toxic int, margin double").collect()  # at most 2 * sample rows
    platt = _platt(np.array([r.margin for r in found]), np.array([1.0 if r.toxic else -1.0 for r in found]),
                   np.array([stands[r.toxic] for r in found]))
    return Model(model.landmarks, model.v, model.bias, platt)


def score(docs: DataFrame, model: Model | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score of every text in one more column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select("*", F.lit(0.0).alias(score_col)).schema

    def apply(batches):
        for batch in batches:
            held = shared.value
            found = held.scores(batch.column(text_col).to_pylist()) if held else np.zeros(len(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())],
                                             names=[*batch.schema.names, score_col])

    return docs.mapInArrow(apply, schema)


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold() != 2)
    rows = docs.withColumn("held_out", F.coalesce(fold() == 2, F.lit(False)))
    return score(rows, train(docs.where(fold() != 2), labels)).select(
        "doc_id", "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
