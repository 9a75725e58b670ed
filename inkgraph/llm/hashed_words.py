"""Words of a batch of texts as arrays: places and 64-bit hashes, without a Python object per word.

A word is a longest run of bytes other than 0x20 and 0x09-0x0D, with A-Z in
lower case.  Its hash is a polynomial over random values of its bytes, taken
from running sums, then mixed; two of n words share a hash with a chance of
about n * n / 2**65.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2**64
BYTE_VALUES = np.random.default_rng(20_231).integers(1, 2**63, 256, dtype=np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
CHUNK = 8 << 20                    # bytes of text in work at a time
BLOCK = 1 << 19                    # bytes that share one running sum


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(BASE, -1, 2**64))
    up, down = np.full(n + 1, BASE, np.uint64), np.full(n + 1, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_table: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse up to ``n``; those for a block are kept in the worker."""
    if n > 2 * BLOCK:
        return _powers(n)
    if not _table:
        _table[:] = _powers(2 * BLOCK)
    return _table[0], _table[1]


@dataclass
class Words:
    """``data``: lower-cased bytes; words in order; those of text i are ``first[i]:first[i + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    _hash: np.ndarray | None = None

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            out = np.empty(len(self.start), np.uint64)
            edge = np.searchsorted(self.start, np.arange(0, len(self.data) + BLOCK, BLOCK))
            for a, b in zip(edge[:-1], edge[1:]):
                if a < b:
                    low, high = int(self.start[a]), int(self.end[b - 1])
                    up, down = powers(high - low)
                    sums = np.zeros(high - low + 1, np.uint64)
                    np.cumsum(BYTE_VALUES[self.data[low:high]] * up[: high - low], out=sums[1:])
                    out[a:b] = (sums[self.end[a:b] - low] - sums[self.start[a:b] - low]) * down[self.start[a:b] - low]
            self._hash = mix(out)
        return self._hash

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]: self.end[i]].tobytes()


def split(texts: list[bytes]) -> Words:
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    data = LOWER[raw]
    space = IS_SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    first = np.searchsorted(start, np.concatenate(([0], ends)))
    return Words(data, start, end, first)


def chunks(column: pa.Array, bytes_each: int = CHUNK):
    """(from, to, texts) of consecutive rows, each about ``bytes_each`` long or one longer text; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    lengths = np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1])
    low, size = 0, 0
    for i, n in enumerate(lengths):
        if size and size + n > bytes_each:
            yield low, i, [t or b"" for t in column.slice(low, i - low).to_pylist()]
            low, size = i, 0
        size += int(n) + 1
    if low < len(column):
        yield low, len(column), [t or b"" for t in column.slice(low).to_pylist()]


class Tally:
    """Counts of 64-bit keys, kept as sorted arrays; emptied by the caller when large."""

    def __init__(self, flush: int = 2_000_000) -> None:
        self.parts, self.size, self.flush = [], 0, flush

    def add(self, keys: np.ndarray) -> None:
        part = np.unique(keys, return_counts=True)
        self.parts.append(part)
        self.size += len(part[0])

    def full(self) -> bool:
        if self.size > self.flush and len(self.parts) > 1:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][0])
        return self.size > self.flush

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, place = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        return keys, np.bincount(place, np.concatenate([n for _, n in self.parts]), len(keys)).astype(np.int64)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = self.merged()
        self.parts, self.size = [], 0
        return out
