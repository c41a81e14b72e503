"""Words of many texts at once: boundaries, counts and 64-bit hashes computed on the UTF-8 bytes with numpy.

A word hash is a polynomial in the word's bytes modulo 2**64, taken from prefix sums over a block of texts, then mixed.
Different words share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_powers = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, BLOCK_BYTES + 1)
        made = []
        for base in (BASE, _INVERSE):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        _powers = (made[0], made[1])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Block:
    """Some consecutive texts of a batch: bytes of all, and where each begins (one more entry for the end)."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.bounds) - 1

    @cached_property
    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """Byte positions where words begin and end; a text's end always ends a word."""
        inside = ~_SPACE[self.data]
        n = len(inside)
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        edges = self.bounds[:-1]
        edges = edges[edges < n]
        begin[edges] = inside[edges]
        edges = edges[edges > 0] - 1
        end[edges] = inside[edges]
        return np.flatnonzero(begin), np.flatnonzero(end) + 1

    @cached_property
    def word_bounds(self) -> np.ndarray:
        """Index of each text's first word, and the number of words at the end."""
        return np.searchsorted(self.spans[0], self.bounds)

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.word_bounds)

    def hashes(self, lower: bool) -> np.ndarray:
        """A hash for each word; with ``lower`` A-Z count as a-z."""
        begin, end = self.spans
        n = len(self.data)
        forth, back = powers(n)
        data = _LOWER[self.data] if lower else self.data
        sums = np.zeros(n + 1, dtype=np.uint64)
        # One more than the byte, so that leading zero bytes count.
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * forth[:n], out=sums[1:])
        return mix((sums[end] - sums[begin]) * back[begin])


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a string column in blocks of about ``limit`` bytes, one text at least; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        yield Block(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def as_long(x: np.ndarray) -> pa.Array:
    """Unsigned 64-bit words as Spark's long."""
    return pa.array(x.view(np.int64))
