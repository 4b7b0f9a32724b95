"""Words and word n-grams of a whole Arrow text column as numpy arrays.

A word is a maximal run of bytes other than space and 0x09-0x0D. Those six bytes never occur inside a
longer UTF-8 sequence, so words are found on the bytes. Words are named by a 64-bit hash: a polynomial
over the bytes, taken from running sums, then mixed. No Python object is made per word.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x5851F42D4C957F2D
BASE_INVERSE = pow(BASE, -1, 1 << 64)
BLOCK_BYTES = 2 << 20


def give_back() -> None:
    """Hand memory that is free to the system at the end of a task: Spark keeps its Python workers for the next ones."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit generator: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text, or of one row; they bound the memory of a step."""
    sizes = np.diff(offsets_of(column))
    start = total = 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and total + size > most:
            yield start, row
            start, total = row, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)


def as_large(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string())


def offsets_of(column: pa.Array) -> np.ndarray:
    """Start of every row's bytes and the end of the last; a null row is empty."""
    if not len(column):
        return np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not column.null_count:
        return offsets
    return np.concatenate([[0], np.cumsum(np.where(np.asarray(column.is_null()), 0, np.diff(offsets)))])


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the rows one after the other, and their offsets from 0."""
    if column.null_count:
        column = column.fill_null("")
    offsets = offsets_of(column)
    data = column.buffers()[2] if len(column) else None
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true; no run crosses a row's start."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    row_starts = offsets[:-1][offsets[:-1] < len(inside)]
    first[row_starts] = inside[row_starts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = inside[ends]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2 ... modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        out[done : 2 * done] = out[: min(done, n - done)] * step
        done *= 2
    return out[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for the bytes of each span, the same wherever the span stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(data) + 1
    sums = np.zeros(n, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n - 1), out=sums[1:])
    raw = (sums[ends] - sums[starts]) * powers(BASE_INVERSE, n)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * GOLDEN)


class Words:
    """The words of some rows: ``hash`` per word, ``first``/``count`` per row."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = bytes_of(column)
        self.starts, self.ends = runs(~is_space(self.data), self.offsets)
        self.hash = span_hashes(self.data, self.starts, self.ends)
        self.first = np.searchsorted(self.starts, self.offsets[:-1])
        self.count = np.searchsorted(self.starts, self.offsets[1:]) - self.first
        self.rows = len(column)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.count)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``n`` words inside a row."""
        starts = np.flatnonzero(self._room() >= n)
        if not len(starts):
            return starts, np.zeros(0, np.uint64)
        return starts, self._hash_runs(starts, n)

    def _room(self) -> np.ndarray:
        """Number of words from each word to the end of its row."""
        return np.repeat(self.first + self.count, self.count) - np.arange(len(self.hash))

    def _hash_runs(self, starts: np.ndarray, lengths: int | np.ndarray) -> np.ndarray:
        total = len(self.hash)
        sums = np.zeros(total + 1, np.uint64)
        np.cumsum(self.hash * powers(BASE, total), out=sums[1:])
        raw = (sums[starts + lengths] - sums[starts]) * powers(BASE_INVERSE, total)[starts]
        return mix(raw + np.asarray(lengths, np.uint64) * GOLDEN)

    def grams(self, n: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of every run of ``n`` words inside a row.

        With ``whole`` a row of 1 to n-1 words gives one gram of all its words.
        """
        starts, value = self.windows(n)
        row = self.row_of_word()[starts]
        if whole:
            short = np.flatnonzero((self.count > 0) & (self.count < n))
            row = np.concatenate([row, short])
            value = np.concatenate([value, self._hash_runs(self.first[short], self.count[short])])
            order = np.argsort(row, kind="stable")
            row, value = row[order], value[order]
        return row, value


def counted(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (row, value) pairs in order of row, then value, with how often each occurs."""
    if not len(row):
        return row, value, np.zeros(0, np.int64)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (value[1:] != value[:-1])]))
    return row[new], value[new], np.diff(np.concatenate([new, [len(row)]]))
