"""Numpy kernels over the UTF-8 bytes of many texts at once.

A batch of texts is one byte array plus offsets, just as Arrow stores a string column, so nothing
is decoded. Every kernel is a handful of array passes; none loops over bytes or words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words, so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= MIX_A
    x ^= x >> np.uint64(27)
    x *= MIX_B
    x ^= x >> np.uint64(31)
    return x


def byte_codes(seed: int) -> np.ndarray:
    """A random 64-bit code for each of the 256 byte values."""
    with np.errstate(over="ignore"):
        return mix((np.arange(256, dtype=np.uint64) + np.uint64(1 + 256 * seed)) * ODD)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def text_batch(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null text is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int):
    """Row ranges of about `limit` bytes each; a longer text is a range of its own."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop
        start = stop


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every (start, length) run, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


BASE = np.uint64(0xD6E8FEB86659FD93)  # of polynomial hashes: odd, so that it has an inverse
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
WHITE = [0x20, *range(0x09, 0x0E)]  # bytes between words: fixed values


class Powers:
    """Powers of the base and of its inverse, grown to the longest batch seen."""

    def __init__(self):
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = powers(BASE, n), powers(BASE_INVERSE, n)
        return self.up, self.down


class Shingler:
    """Hashes of the distinct word n-grams of many texts: A-Z lower-cased, words between blanks.

    A text of one to n - 1 words has a single shingle, the whole sequence; one without words none.
    """

    def __init__(self, n: int):
        self.n = n
        self.powers = Powers()
        fold = np.arange(256)
        fold[65:91] += 32
        self.codes = byte_codes(5)[fold]
        self.codes[WHITE] = 0
        self.word = np.ones(256, dtype=bool)
        self.word[WHITE] = False

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word, and the first word of every text (one entry more)."""
        n = len(data)
        inside = self.word[data]
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        bounds = offsets[:-1][offsets[:-1] < n]
        start[bounds] = inside[bounds]
        starts = np.flatnonzero(start)
        if not len(starts):
            return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
        up, down = self.powers.to(n)
        sums = np.add.reduceat(self.codes[data] * up[:n], starts)
        return mix(sums * down[starts]), np.searchsorted(starts, offsets)

    def sets(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of every text."""
        n = self.n
        words, first = self.words(data, offsets)
        if len(words) >= n:
            long = words[: len(words) - n + 1].copy()
            for i in range(1, n):
                long = long * ODD + words[i : len(words) - n + 1 + i]
            long = mix(long + np.uint64(n))
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= n:
                out.append(np.unique(long[a : b - n + 1]))
            else:
                short = np.zeros(min(1, b - a), dtype=np.uint64)
                for w in words[a:b]:
                    short = short * ODD + w
                out.append(mix(short + np.uint64(b - a)))
        return out
