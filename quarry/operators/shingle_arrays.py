"""Character shingles of many texts at once, as numpy arrays inside Spark tasks.

A shingle is a run of ``n`` code points. It is known by a 64-bit hash of its code
points; where its characters count (the md5 of a signature), each distinct
shingle of a slice is read once. Work goes in slices of about ``SLICE`` bytes of
text, so memory follows the longest text of a slice, not the batch.

A sketch is a bitmap of about twice a set's size in which every shingle flips
one bit. Shared shingles cancel out, so two sets differ in at least as many
shingles as their sketches do in bits. A sketch is folded to half its width by an
exclusive or of its halves, so sets of different sizes compare, too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
KNOWN = 1 << 20  # md5 values that a task keeps
LEAST_BITS = 64
_MUL = np.random.default_rng(20240305).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, list[str]]]:
    """(first row, last row, texts) for runs of rows of about ``limit`` bytes; a null is an empty text."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    lo, n = 0, len(column)
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1))
        yield lo, hi, [t.decode("utf-8", "replace") for t in column.slice(lo, hi - lo).to_pylist()]
        lo = hi


def grams(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place in the joined texts, of every shingle, repeated ones too; shingles of each text)."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    counts = np.maximum(lengths - (n - 1), 0)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    if not counts.sum():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), counts
    h = np.zeros(len(codes) - n + 1, dtype=np.uint64)
    for k in range(n):
        h += codes[k:len(codes) - n + 1 + k] * _MUL[k]
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    places = inside + np.repeat(np.cumsum(lengths) - lengths, counts)
    return _mix(h[places]), places, counts


def _first(ranked: np.ndarray) -> np.ndarray:
    """Which of some sorted values are the first of their kind."""
    return np.concatenate([np.ones(min(len(ranked), 1), bool), ranked[1:] != ranked[:-1]])


def sets(texts: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    h, _, counts = grams(texts, n)
    ranked = [np.sort(h[e - c:e]) for c, e in zip(counts, np.cumsum(counts))]
    return [r[_first(r)] for r in ranked]


def numbered(held: dict) -> tuple[dict, np.ndarray]:
    """(the lists of sets by their keys, with numbers from 0 on for their hashes; a flag, false, for each number)."""
    parts = [s for own in held.values() for s in own]
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    order = np.argsort(flat)
    new = _first(flat[order])
    number = np.empty(len(flat), np.int64)
    number[order] = np.cumsum(new) - 1
    cut = iter(np.split(number, np.cumsum([len(s) for s in parts])[:-1]))
    return {key: [next(cut) for _ in own] for key, own in held.items()}, np.zeros(int(new.sum()), bool)


def _md5_31(text: str, places: np.ndarray, n: int) -> np.ndarray:
    """First 31 bits of the md5 of the shingle at each place."""
    heads = b"".join([hashlib.md5(text[p:p + n].encode(), usedforsecurity=False).digest()[:4] for p in places.tolist()])
    return (np.frombuffer(heads, dtype=">u4") >> 1).astype(np.uint64)


class Known:
    """md5 values of shingles by their hash; starts anew when ``KNOWN`` are held."""

    def __init__(self):
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def look_up(self, keys: np.ndarray, text: str, places: np.ndarray, n: int) -> np.ndarray:
        """Values of the sorted distinct ``keys``, which stand at ``places`` of ``text``."""
        at = np.searchsorted(self.keys, keys)
        held = np.zeros(len(keys), dtype=bool)
        if len(self.keys):
            at = np.minimum(at, len(self.keys) - 1)
            held = self.keys[at] == keys
        out = np.empty(len(keys), dtype=np.uint64)
        out[held] = self.values[at[held]]
        out[~held] = _md5_31(text, places[~held], n)
        new = ~held
        if len(self.keys) + new.sum() > KNOWN:
            self.keys, self.values = keys, out
        elif new.any():
            place = np.searchsorted(self.keys, keys[new])
            self.keys, self.values = np.insert(self.keys, place, keys[new]), np.insert(self.values, place, out[new])
        return out


def signed(texts: list[str], n: int, perms: list[tuple[int, int]], prime: int, known: Known) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(``sets``, rows with a shingle, their least permuted md5 values: one row each)."""
    h, places, counts = grams(texts, n)
    held, at = [], []
    for c, e in zip(counts, np.cumsum(counts)):
        order = np.argsort(h[e - c:e])
        ranked = h[e - c:e][order]
        first = _first(ranked)
        held.append(ranked[first]), at.append(places[e - c:e][order[first]])
    full = np.flatnonzero(counts)
    out = np.zeros((len(full), len(perms)), dtype=np.int64)
    if len(full):
        flat, at = np.concatenate(held), np.concatenate(at)
        order = np.argsort(flat)
        ranked = flat[order]
        new = _first(ranked)
        x = known.look_up(ranked[new], "".join(texts), at[order[new]], n)
        which = np.empty(len(flat), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        sizes = np.array([len(s) for s in held])
        starts = (np.cumsum(sizes) - sizes)[full]
        taken = np.empty(len(flat), dtype=np.uint32)
        for k, (a, b) in enumerate(perms):
            permuted = ((x * np.uint64(a) + np.uint64(b)) % np.uint64(prime)).astype(np.uint32)
            out[:, k] = np.minimum.reduceat(np.take(permuted, which, out=taken, mode="clip"), starts)
    return held, full, out


def signatures(texts: list[str], n: int, perms: list[tuple[int, int]], prime: int, known: Known) -> tuple[np.ndarray, np.ndarray]:
    """(rows with a shingle, their least permuted md5 values: one row each)."""
    return signed(texts, n, perms, prime, known)[1:]


def sketch(s: np.ndarray) -> np.ndarray:
    """The sketch (uint64 words) of a set of hashes."""
    bits = max(LEAST_BITS, 1 << int(len(s)).bit_length())
    flips = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (the last axis) folded to ``words`` words."""
    while sketches.shape[-1] > words:
        half = sketches.shape[-1] // 2
        sketches = sketches[..., :half] ^ sketches[..., half:]
    return sketches


def may_reach(a: np.ndarray, n: int, others: np.ndarray, m: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the ``others`` (equally wide sketches of sets of sizes m) may reach the threshold with the set of sketch a; no pair is lost."""
    words = min(len(a), others.shape[-1])
    apart = np.bitwise_count(folded(others, words) ^ folded(a, words)).sum(axis=-1, dtype=np.int64)
    sized = np.minimum(n, m) >= threshold * np.maximum(n, m)
    # |A xor B| = (n + m)(1 - J) / (1 + J); the last term is for rounding
    return sized & (apart <= (n + m) * (1 - threshold) / (1 + threshold) + 1e-6)


def lists(parts: list[np.ndarray]) -> pa.ListArray:
    """An Arrow column of uint64 arrays, as bigint."""
    offsets = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))
