"""Vectorised words over Arrow string columns.

A word is a run of bytes other than space and U+0009..U+000D. All functions
work on a *slice*: some documents' bytes end to end, so that numpy runs over
megabytes at a time instead of over one document, and memory is bounded by the
slice (or by one document, where that is longer).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 3 << 20

_WS = np.zeros(256, bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

U64 = np.uint64
# The increment and multipliers of the splitmix64 generator.
_GAMMA, _M1, _M2 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
BASE = U64(0xD6E8FEB86659FD93)   # odd, so that its powers have inverses mod 2**64
BASE2 = U64(0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values (splitmix64's finish)."""
    x = (x ^ (x >> U64(30))) * _M1
    x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


def numbers(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mix(U64(seed) + _GAMMA * np.arange(1, n + 1, dtype=U64))


_BYTE = numbers(11, 256)
_POW = np.ones(1, U64)


def _powers(n: int) -> np.ndarray:
    global _POW
    if len(_POW) < n:
        full = np.full(max(n, 2 * len(_POW)), BASE, U64)
        full[0] = 1
        _POW = np.multiply.accumulate(full)
    return _POW[:n]


def string_slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) over a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if not len(col):
        return
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = int(np.searchsorted(off, off[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), len(col))
        yield lo, hi, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


class Words:
    """The words of a slice: byte ranges, 64-bit hashes, and each document's range of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        solid = ~_WS[data]
        before = np.zeros(len(data) + 1, bool)
        before[1:] = solid
        before[offsets] = False            # a document's first byte starts a word
        after = np.zeros(len(data) + 1, bool)
        after[:-1] = solid
        after[offsets] = False             # and its last byte ends one
        self.start = np.flatnonzero(solid & ~before[:-1])
        self.end = np.flatnonzero(solid & ~after[1:]) + 1
        self.first = np.searchsorted(self.start, offsets)   # document d: words first[d]..first[d+1]
        self.doc_end = np.repeat(self.first[1:], np.diff(self.first))
        self.doc_start = np.repeat(self.first[:-1], np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        if not len(self):
            return np.zeros(0, U64)
        size = self.end - self.start
        at = np.concatenate(([0], np.cumsum(size)[:-1]))
        place = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(at, size)
        solid = self.data[~_WS[self.data]]
        with np.errstate(over="ignore"):
            part = _BYTE[solid] * _powers(int(size.max()))[place]
            return mix(np.add.reduceat(part, at) + size.astype(U64) * _GAMMA)


def windows(h: np.ndarray, k: int, base: np.uint64 = BASE) -> np.ndarray:
    """Hashes of every k consecutive word hashes (those over a document's end included)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        acc = h[:n].copy()
        for j in range(1, k):
            acc *= base
            acc += h[j:j + n]
        return mix(acc)


def sliding(x: np.ndarray, w: int, op) -> np.ndarray:
    """op (np.minimum or np.maximum) over every w consecutive values."""
    if len(x) < w:
        return x[:0]
    size, cur = 1, x
    while 2 * size <= w:
        cur = op(cur[:-size], cur[size:])
        size *= 2
    n = len(x) - w + 1
    return op(cur[:n], cur[w - size:w - size + n])
