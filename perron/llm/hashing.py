"""Words and word windows of many texts at once, as arrays of 64-bit hashes.

A batch of texts is one byte array with offsets. A word is a run of bytes other
than 0x20 and 0x09-0x0D. Word hashes come from one prefix sum over all bytes
(a polynomial modulo 2**64 over random byte codes), so no word becomes a Python
object.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 5
PIECE_BYTES = 1 << 19

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every input bit reaches every output bit."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


@lru_cache(maxsize=2)
def byte_codes(fold_case: bool) -> np.ndarray:
    """A random odd code per byte; with ``fold_case`` A-Z share those of a-z."""
    codes = mix(np.arange(1, 257, dtype=U64) * U64(BASE)) | U64(1)
    if fold_case:
        codes[0x41:0x5B] = codes[0x61:0x7B]
    return codes


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; arrays are shared by sizes up to a power of two."""
    return _powers(1 << max(10, (n - 1).bit_length()), base)[:n]


class Words:
    """Words of a batch: ``start`` and ``end`` bytes, ``text`` (row of each word), ``first`` (first word per text)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1 : n + 1] = ~SPACE[data]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        self.start = np.flatnonzero(inside[1 : n + 1] & (~inside[:n] | cut[:n]))
        self.end = np.flatnonzero(inside[1 : n + 1] & (~inside[2:] | cut[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.text = np.repeat(np.arange(len(offsets) - 1), self.count)

    def hashes(self, fold_case: bool = False) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, U64)
        n = len(self.data)
        sums = np.zeros(n + 1, U64)
        np.cumsum(byte_codes(fold_case)[self.data] * powers(n, BASE), out=sums[1:])
        back = powers(n, pow(BASE, -1, 1 << 64))
        return mix((sums[self.end] - sums[self.start]) * back[self.start])


def window_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A hash for each ``size`` consecutive word hashes; windows over text borders are for the caller to skip."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    base = (BASE + 8 * seed) % (1 << 64)
    out = np.zeros(n, U64)
    coded = words if not seed else mix(words + U64(seed))
    for j in range(size):
        out += coded[j : j + n] * U64(pow(base, j + 1, 1 << 64))
    return mix(out)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string array; nulls count as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches at rows so that a piece has about ``size`` bytes of ``column`` (or one row)."""
    for batch in batches:
        lengths = np.diff(text_bytes(batch.column(column))[1])
        if not len(lengths):
            continue
        ends = np.cumsum(lengths)
        at = 0
        while at < len(lengths):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(at, to - at)
            at = to
