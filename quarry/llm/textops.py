"""Vectorized word and shingle hashing for Arrow batches (numpy inside Spark tasks).

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased.
A document's shingles are the hashes of its 5-word windows; with one to four
words the whole sequence is its only shingle; without words it has none.

Work goes in slices of about a megabyte, so memory follows the longest document
of a slice, not the batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (kept per worker, grown when needed)."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        n = max(n, SLICE + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        for name, b in (("up", _BASE), ("down", inverse)):
            p = np.full(n, b, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def _slice_words(d: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each word of ``d``; ``first`` marks bytes that begin a document."""
    d = np.where((d >= 65) & (d <= 90), d | 32, d)
    word = ~((d == 32) | ((d >= 9) & (d <= 13)))
    before = np.empty(len(d), dtype=bool)
    before[0] = False
    before[1:] = word[:-1]
    start = np.flatnonzero(word & (~before | first))
    after = np.empty(len(d), dtype=bool)
    after[-1] = False
    after[:-1] = word[1:] & ~first[1:]
    end = np.flatnonzero(word & ~after) + 1
    up, down = _powers(len(d) + 1)
    total = np.zeros(len(d) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[d] * up[:len(d)], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    return mix(h ^ ((end - start).astype(np.uint64) << np.uint64(48))), start


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in order, words per document)."""
    n, counts = len(data), np.zeros(len(offsets) - 1, dtype=np.int64)
    first = np.zeros(n + 1, dtype=bool)
    first[offsets[:-1]] = True
    out, at = [], 0
    while at < n:
        to = min(at + SLICE, n)
        while to < n:
            # cut only where no word is cut: at a blank or where a document begins
            window = data[at:to]
            cut = np.flatnonzero((window == 32) | ((window >= 9) & (window <= 13)) | first[at:to])
            cut = cut[cut > 0]
            if len(cut):
                to = at + int(cut[-1])
                break
            to = min(to + SLICE, n)
        h, start = _slice_words(data[at:to], first[at:to])
        out.append(h)
        which = np.searchsorted(offsets, start + at, side="right") - 1
        counts += np.bincount(which, minlength=len(counts))
        at = to
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), counts


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (uint64) of each document."""
    h, counts = words(data, offsets)
    ends = np.cumsum(counts)
    sets = []
    rolled = None
    if len(h) >= width:
        rolled = np.zeros(len(h) - width + 1, dtype=np.uint64)
        for k in range(width):
            rolled += h[k:len(h) - width + 1 + k] * _PLACE[k]
        rolled = mix(rolled)
    for n, e in zip(counts, ends):
        s = e - n
        if n >= width:
            sets.append(np.unique(rolled[s:e - width + 1]))
        elif n:
            whole = (h[s:e] * _PLACE[:n]).sum(dtype=np.uint64) + np.uint64(n)
            sets.append(mix(np.array([whole], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE):
    """(first row, last row, bytes, offsets) for runs of rows of about ``limit`` bytes."""
    data, offsets = text_bytes(batch.column(column))
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi
