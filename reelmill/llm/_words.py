"""Words of Arrow string columns as numpy arrays: boundaries and 64-bit hashes, without a Python string for any word.

A word is a longest run of bytes other than 0x20 and 0x09-0x0D, which is the pattern ``[^\\x20\\x09-\\x0D]+`` in UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_B, _B_INV = _U(0x9E3779B97F4A7C15), _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _B)
_BYTE[_SPACE] = 0


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


def slices(column: pa.Array, max_bytes: int = 500_000, max_rows: int = 4000) -> Iterator[tuple[int, int]]:
    """Row ranges of about max_bytes of text; a longer text is a range of its own."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        to = max(at + 1, min(at + max_rows, int(np.searchsorted(ends, base + max_bytes, "right"))))
        yield at, to
        at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each starts (one more for the end). Null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


class Words:
    """The words of a run of texts: ``start`` and ``end`` in ``data``; the words of text i are first[i]:first[i + 1]."""

    def __init__(self, column: pa.Array, lower: bool = False):
        data, self.at = text_bytes(column)
        self.data = LOWER[data] if lower else data
        n = len(data)
        inside = ~_SPACE[data]
        before = np.zeros(n + 1, bool)
        before[1:] = inside
        cut = self.at[self.at < n]
        after = np.zeros(n + 1, bool)
        after[:n] = inside
        before[cut] = False
        self.start = np.flatnonzero(inside & ~before[:n])
        last = after[1:].copy()
        last[cut[cut > 0] - 1] = False
        self.end = np.flatnonzero(inside & ~last) + 1
        self.first = np.searchsorted(self.start, self.at)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.start):
            return np.zeros(0, _U)
        data = self.data[self.start[0] :]
        start = self.start - self.start[0]
        gap = np.diff(start, append=len(data))
        at = np.arange(len(data)) - np.repeat(start, gap)
        h = np.add.reduceat(_BYTE[data] * _powers(_B, int(gap.max()))[at], start)
        return mix(h + (self.end - self.start).astype(_U) * _U(0xD6E8FEB86659FD93))

    def windows(self, h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
        """The hash of the k values that start at each of h, wherever k follow (the caller looks at text ends)."""
        n = len(h)
        if n < k:
            return np.zeros(0, _U)
        h = mix(h ^ mix(np.array([seed + 1], _U))) if seed else h
        s = np.zeros(n + 1, _U)
        np.cumsum(h * _powers(_B, n), out=s[1:])
        return mix((s[k:] - s[: n - k + 1]) * _powers(_B_INV, n - k + 1))

    def inside(self, k: int) -> np.ndarray:
        """Where a window of k words lies in one text; as long as windows()."""
        n = len(self) - k + 1
        if n <= 0:
            return np.zeros(0, bool)
        size = np.diff(self.first)
        left = np.repeat(self.first[1:], size) - np.arange(len(self))
        return left[:n] >= k

    def text_of(self) -> np.ndarray:
        """The text (row) of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def columns(batch: pa.RecordBatch, *names: str) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(x)) for x in names]
