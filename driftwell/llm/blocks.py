"""Arrow batches of texts as flat NumPy arrays: words, word hashes, window hashes, sliding minima.

All functions work on one Arrow batch at a time, so memory is bounded by the batch (see
``table.bounded_batches``) or by the longest single text. Hashes are 64-bit and depend on content only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
INDEXES = 1 << 32  # of a batch


def constants(name: str, n: int) -> np.ndarray:
    """``n`` odd 64-bit numbers that depend on ``name`` only."""
    raw = hashlib.shake_256(name.encode()).digest(8 * n)
    return np.frombuffer(raw, dtype="<u8").astype(U) | U(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (a published finaliser)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and ``n + 1`` offsets into them; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = raw.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[raw.offset : raw.offset + len(raw) + 1]
    if data is None or len(raw) == 0:
        return np.empty(0, np.uint8), np.zeros(len(raw) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = constants("byte", 256)
_POWER = int(constants("power", 1)[0])


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _POWER, U)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a batch: byte spans and where each text's words begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = ~_SPACE[data]
        edge = offsets[(offsets > 0) & (offsets < len(data))]
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = inside[:-1]
        before[edge] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        after[edge - 1] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)  # words of text i: first[i] .. first[i + 1]
        self.inside = inside

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.start):
            return np.empty(0, U)
        mark = np.zeros(len(self.data), np.int64)
        mark[self.start] = self.start
        place = np.arange(len(self.data)) - np.maximum.accumulate(mark)
        place[~self.inside] = 0
        terms = _BYTE[self.data]
        terms *= _powers(int((self.end - self.start).max()))[place]
        terms[~self.inside] = 0
        sums = np.add.reduceat(terms, self.start)
        return mix64(sums + (self.end - self.start).astype(U) * _BYTE[0])


def window_hashes(values: np.ndarray, size: int, name: str) -> np.ndarray:
    """Hash of each run of ``size`` values, by its start (runs may cross texts; callers mask those)."""
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, U)
    factors = constants(name, size)
    total = np.zeros(n, U)
    for j in range(size):
        total += values[j : j + n] * factors[j]
    return mix64(total)


def sliding_argmin(values: np.ndarray, size: int) -> np.ndarray:
    """Index of the smallest of each ``size`` consecutive values, the first of equals.

    Values are compared by their upper half, whatever the length of the batch, so equal windows choose the
    same place wherever they stand; the lower half holds the index."""
    n = len(values)
    if n < size:
        return np.empty(0, np.int64)
    if n > INDEXES:
        raise ValueError(f"{n} places in a batch; {INDEXES} can be told apart")
    low = U(INDEXES - 1)
    best = (values & ~low) | np.arange(n, dtype=U)
    width = 1
    while width < size:
        step = min(width, size - width)
        best = np.minimum(best[:-step], best[step:])
        width += step
    return (best & low).astype(np.int64)


def spans_to_mask(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Boolean mask of length ``n`` that is true inside any of the spans."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, start, 1)
    np.add.at(edges, end, -1)
    return np.cumsum(edges[:-1]) > 0
