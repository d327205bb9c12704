"""Words of many texts at once, in numpy: bounds and 64-bit hashes over Arrow's own buffers.

Used inside tasks, on one Arrow batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# An odd number and its inverse modulo 2**64: hashes of all substrings come from one running sum.
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)


class _Powers:
    """Powers of the base and of its inverse, as many as the longest slice needed so far."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, factor in (("up", BASE), ("down", _INVERSE)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps))
        return cls.up, cls.down


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Words:
    """The words of a slice of texts: ``doc`` (index of the text), ``start`` and ``end`` (bytes), ``hash``."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, lower: bool):
        """``data``: the bytes of all texts; ``ends``: where each text ends."""
        self.n_docs = len(ends)
        data = _LOWER[data] if lower else data
        self.data = data
        word = ~_SPACE[data]
        first = np.zeros(len(data) + 1, bool)
        first[0] = True
        first[ends] = True
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = word[:-1]
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = word[1:]
        self.start = np.flatnonzero(word & (~before | first[:-1]))
        self.end = np.flatnonzero(word & (~after | first[1:])) + 1
        self.doc = np.searchsorted(ends, self.start, side="right")
        up, down = _Powers.of(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
        h = (sums[self.end] - sums[self.start]) * down[self.start]
        self.hash = mix(h ^ (self.end - self.start).astype(np.uint64) * np.uint64(BASE))

    def count(self) -> np.ndarray:
        """Words per text."""
        return np.bincount(self.doc, minlength=self.n_docs)

    def bounds(self) -> np.ndarray:
        """Where the words of each text begin among all words; one more at the end."""
        return np.concatenate([[0], np.cumsum(self.count())])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of an Arrow array, and offsets; a NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of some ``most`` bytes together, at least one text each."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, hi
        lo = hi


def words_of(texts: pa.Array, lower: bool = True) -> Iterator[tuple[int, int, Words]]:
    """``Words`` of ranges of texts; each text whole in one range."""
    data, offsets = text_bytes(texts)
    for lo, hi in slices(offsets):
        part = data[offsets[lo] : offsets[hi]]
        yield lo, hi, Words(part, offsets[lo + 1 : hi + 1] - offsets[lo], lower)
