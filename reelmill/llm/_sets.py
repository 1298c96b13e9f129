"""Shingle sets of texts and their b-bit min-hash signatures, as numpy arrays."""

from __future__ import annotations

import numpy as np

from reelmill.llm._words import Words, mix

_U = np.uint64
#: Texts in one call: a shingle is held as 52 bits of its hash below 12 bits of its text's place, so one plain sort makes all sets.
MAX_TEXTS = 4000


class Sets:
    """The distinct shingles of a run of texts: those of text i are values[first[i]:first[i + 1]], ascending."""

    def __init__(self, words: Words, k: int):
        h, texts = words.hashes(), len(words.first) - 1
        all_, whole = words.windows(h, k), words.inside(k)
        row, value = words.text_of()[: len(all_)][whole], all_[whole]
        size = np.diff(words.first)
        for n in range(1, k):  # fewer words than a shingle has: the whole sequence
            short = np.flatnonzero(size == n)
            row, value = np.append(row, short), np.append(value, words.windows(h, n, seed=n)[words.first[short]])
        keys = np.unique((row.astype(_U) << _U(52)) | (value >> _U(12)))
        self.first = np.searchsorted(keys, np.arange(texts + 1, dtype=_U) << _U(52))
        self.values = keys & _U((1 << 52) - 1)

    def sizes(self) -> np.ndarray:
        return np.diff(self.first)

    def _reduce(self, f: np.ufunc, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.first) - 1, _U)
        some = np.flatnonzero(self.sizes())
        if len(some):
            out[some] = f.reduceat(values, self.first[some])
        return out

    def identity(self, seed: int) -> np.ndarray:
        """64 bits that equal sets share; two seeds make 128."""
        return self._reduce(np.add, mix(self.values * _U(2 * seed + 1) + _U(seed)))

    def signatures(self, functions: int) -> np.ndarray:
        """b = 16 bits of the least hash under each function; two sets agree in one with their Jaccard similarity."""
        odd = mix(np.arange(1, functions + 1, dtype=_U)) | _U(1)
        return np.stack([mix(self._reduce(np.minimum, self.values * a)).astype(np.uint16) for a in odd], 1)


def chunk_keys(signatures: np.ndarray, chunks: int) -> np.ndarray:
    """One key for each chunk of a signature and each place in it that may differ.

    Signatures that differ in fewer than 2 * chunks places have a chunk with at most one difference (pigeonhole), and
    so share the key that leaves this place out.
    """
    n, functions = signatures.shape
    parts = mix(signatures.astype(_U) + (np.arange(1, functions + 1, dtype=_U) << _U(20))).reshape(n, chunks, -1)
    left = parts.sum(2, keepdims=True, dtype=_U) - parts
    return mix(left.reshape(n, functions) + mix(np.arange(1, functions + 1, dtype=_U) << _U(32)))
