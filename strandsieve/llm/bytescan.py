"""Vectorised work on the UTF-8 bytes of whole Arrow string columns.

A word is a maximal run of bytes other than space and 0x09-0x0D. No byte of a longer UTF-8 sequence is below 0x80,
so the byte view and the code-point view of words are the same.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Every ASCII byte that is neither a letter nor a digit.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes taken together; a single longer text is taken alone.
CHUNK = (1 << 18) - 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(29)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(32)
    return x


def seeded(seed: int, n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


class WordHasher:
    """64-bit hashes of variable-length words by prefix sums of a polynomial over the bytes (arithmetic mod 2^64)."""

    def __init__(self, seed: int) -> None:
        self.byte = seeded(seed, 256)
        self.base = int(seeded(seed ^ 0x5BD1E995, 1)[0]) | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def _powers(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * U64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * U64(pow(self.inverse, k, 1 << 64))])

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, U64)
        self._powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(self.byte[data] * self.up[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(U64))


class NgramHasher:
    """Order-sensitive 64-bit hashes of each run of `n` consecutive words, from the words' hashes."""

    def __init__(self, n: int, seed: int) -> None:
        self.n, self.base = n, int(seeded(seed, 1)[0]) | 1

    def __call__(self, words: np.ndarray) -> np.ndarray:
        if len(words) < self.n:
            return np.zeros(0, U64)
        have, span, done, at = words, 1, None, 0
        n = self.n
        while n:
            if n & 1:
                if done is None:
                    done, at = have, span
                else:
                    m = len(words) - at - span + 1
                    done, at = done[:m] + have[at : at + m] * U64(pow(self.base, at, 1 << 64)), at + span
            n >>= 1
            if n:
                m = len(words) - 2 * span + 1
                have = have[:m] + have[span : span + m] * U64(pow(self.base, span, 1 << 64))
                span *= 2
        return mix(done[: len(words) - self.n + 1])


def release_memory() -> None:
    """Gives back what earlier work in this Python worker has freed; workers live on between stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        return


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run`, which gives back at its end what it has freed, so that the executor's next stage has it."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    return whole


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    _, off, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups(offsets: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose bytes are worked on together."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and for each row the index of its first word (one more at the end)."""
    inside = ~between[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    now = np.zeros(len(data) + 1, bool)
    now[:-1] = inside
    starts = np.flatnonzero(now & (~before | edge))
    ends = np.flatnonzero(before & (~now | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def hashed_words(column: pa.Array, hashers: list[WordHasher], lower: bool = False, between: np.ndarray = SPACE) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For each row of a string column: its number in the column, and its words' hashes by each hasher."""
    data, offsets = utf8(column)
    for i, j in groups(offsets):
        part = data[offsets[i] : offsets[j]]
        part = lowered(part) if lower else part
        starts, ends, first = words(part, offsets[i : j + 1] - offsets[i], between)
        all_hashes = [h(part, starts, ends) for h in hashers]
        for k in range(j - i):
            yield i + k, [h[first[k] : first[k + 1]] for h in all_hashes]
