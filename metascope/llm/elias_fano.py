"""Elias-Fano sequences and a two-level trie of word pairs, in numpy over memory-mapped files.

A monotone sequence keeps the low bits of its values packed, and the high bits as
a unary bit vector.  Searches are vectorised: many values at once.
"""

from __future__ import annotations

import tempfile

import numpy as np


def mapped(array: np.ndarray) -> np.ndarray:
    """The array in a memory-mapped file without a name, which goes when the array does."""
    if not array.size:
        return array
    with tempfile.TemporaryFile() as file:
        array.tofile(file)
        file.flush()
        return np.memmap(file, array.dtype, "r", shape=array.shape)


class EliasFano:
    """A sorted sequence of unsigned numbers below ``universe``."""

    def __init__(self, values: np.ndarray, universe: int):
        values = values.astype(np.uint64)
        self.n = len(values)
        self.bits = max(0, (universe // max(self.n, 1)).bit_length() - 1)
        low = values & np.uint64((1 << self.bits) - 1)
        at = np.arange(self.n, dtype=np.uint64) * np.uint64(self.bits)
        words = np.zeros(self.n * self.bits // 64 + 2, np.uint64)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        np.bitwise_or.at(words, word, low << shift)
        over = (shift + np.uint64(self.bits) > 64).nonzero()[0]
        np.bitwise_or.at(words, word[over] + 1, low[over] >> (np.uint64(64) - shift[over]))
        high = (values >> np.uint64(self.bits)).astype(np.int64)
        unary = np.zeros(self.n + (universe >> self.bits) + 2, bool)
        unary[high + np.arange(self.n)] = True
        self.low, self.unary, self.length = mapped(words), mapped(np.packbits(unary)), len(unary)

    def _unary(self) -> np.ndarray:
        return np.unpackbits(self.unary, count=self.length).astype(bool)

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(at), np.uint64)
        place = at.astype(np.uint64) * np.uint64(self.bits)
        word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
        rest = np.where(shift == 0, np.uint64(0), self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)))
        return (self.low[word] >> shift | rest) & np.uint64((1 << self.bits) - 1)

    def values(self) -> np.ndarray:
        high = np.flatnonzero(self._unary()) - np.arange(self.n)
        return high.astype(np.uint64) << np.uint64(self.bits) | self._low(np.arange(self.n))

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Positions of the wanted values, -1 where there are none."""
        wanted = wanted.astype(np.uint64)
        if not self.n or not len(wanted):
            return np.full(len(wanted), -1, np.int64)
        zeros = np.flatnonzero(~self._unary())
        first = np.concatenate([[0], zeros - np.arange(len(zeros))])
        bucket = np.minimum(wanted >> np.uint64(self.bits), np.uint64(len(first) - 2)).astype(np.int64)
        lo, end = first[bucket], first[bucket + 1]
        hi, low = end.copy(), wanted & np.uint64((1 << self.bits) - 1)
        while (open_ := np.flatnonzero(lo < hi)).size:
            middle = (lo[open_] + hi[open_]) >> 1
            less = self._low(middle) < low[open_]
            lo[open_[less]] = middle[less] + 1
            hi[open_[~less]] = middle[~less]
        found = np.full(len(wanted), -1, np.int64)
        inside = np.flatnonzero(lo < end)
        same = inside[self._low(lo[inside]) == low[inside]]
        found[same] = lo[same]
        return found


STEPS = 24  # quantisation steps per power of ten beyond the exact small counts
_EXACT = 64


def quantised(counts: np.ndarray) -> np.ndarray:
    """One byte for a count > 0: itself if small, else its logarithm in steps; 0 for 0."""
    large = _EXACT + np.round(np.log10(np.maximum(counts, 1) / _EXACT) * STEPS)
    return np.where(counts < _EXACT, counts, np.clip(large, _EXACT, 255)).astype(np.uint8)


def restored(codes: np.ndarray) -> np.ndarray:
    return np.where(codes < _EXACT, codes, _EXACT * 10.0 ** ((codes.astype(float) - _EXACT) / STEPS))


class PairTrie:
    """Words and their successors with a byte for each pair.

    Level one holds the contexts and, as another monotone sequence, where each
    one's successors begin.  Level two holds the successors' ids among the trie's
    words; as each context's ids come after those before it, one monotone sequence
    holds them all, and a pair is found by a search in its context's range.
    """

    def __init__(self, context: np.ndarray, word: np.ndarray, count: np.ndarray):
        """Sorted by context, then word; each pair once, with a count > 0."""
        contexts, begins = np.unique(context, return_index=True)
        words, ids = np.unique(word, return_inverse=True)
        self.contexts = EliasFano(contexts, 1 << 40)
        self.begins = EliasFano(np.append(begins, len(context)), len(context) + 1)
        self.words = EliasFano(words, 1 << 40)
        self.width = max(len(words), 1)
        own = np.repeat(np.arange(len(contexts)), np.diff(np.append(begins, len(context))))
        self.successors = EliasFano(own * self.width + ids, max(len(contexts), 1) * self.width)
        self.codes = mapped(quantised(count))

    def codes_of(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The bytes of the pairs; 0 for one that isn't there."""
        at, to = self.contexts.find(context), self.words.find(word)
        out = np.zeros(len(context), np.uint8)
        known = np.flatnonzero((at >= 0) & (to >= 0))
        found = self.successors.find(at[known] * self.width + to[known])
        begins = self.begins.values().astype(np.int64)
        inside = (found >= begins[at[known]]) & (found < begins[at[known] + 1])
        out[known[inside]] = self.codes[found[inside]]
        return out
