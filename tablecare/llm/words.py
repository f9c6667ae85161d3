"""Words, windows and lines of a batch of texts as numpy arrays.

A task works through slices of a few megabytes, so its memory does not depend on the size of its partition. Words are runs of
bytes other than ASCII white space, as in ``[^\\x20\\x09-\\x0D]+``; hashes have 64 bits and depend only on the word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
"""Bytes of text that are looked at together; a longer text is a slice of its own."""

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEPS = [np.uint64((0xD6E8FEB86659FD93 * (2 * i + 1)) & (2**64 - 1) | 1) for i in range(64)]

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(size: int, least: int = SLICE_BYTES + 1) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``size`` and ``least`` of them."""
    return _powers(max(least, 1 << int(size).bit_length()))


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) of parts of an Arrow string column of ``most`` bytes, or of one longer text; a null text is empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


@dataclass
class Words:
    """The words of some texts: where each starts and ends, and at which word each text begins."""

    data: np.ndarray
    offsets: np.ndarray

    @cached_property
    def space(self) -> np.ndarray:
        return _SPACE[self.data]

    @cached_property
    def _edges(self) -> tuple[np.ndarray, np.ndarray]:
        inside = ~self.space
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = self.offsets[(self.offsets > 0) & (self.offsets < len(inside))]
        starts[cuts] |= inside[cuts]
        ends[cuts - 1] |= inside[cuts - 1]
        return np.flatnonzero(starts), np.flatnonzero(ends) + 1

    @property
    def starts(self) -> np.ndarray:
        return self._edges[0]

    @cached_property
    def first(self) -> np.ndarray:
        """Index of the first word of each text, and the number of words at the end."""
        return np.searchsorted(self.starts, self.offsets)

    @cached_property
    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A hash of each word."""
        return spans_hash(_LOWER[self.data] if lower else self.data, *self._edges)


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each byte range, equal for equal bytes."""
    up, down = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words, one per start; runs may cross texts."""
    count = max(0, len(hashes) - size + 1)
    total = np.zeros(count, np.uint64)
    for i in range(size):
        total += hashes[i : i + count] * _STEPS[i]
    return mix(total)


def shingle_sets(words: Words, hashes: np.ndarray, size: int) -> list[np.ndarray]:
    """Of each text, the distinct hashes of its runs of ``size`` words; with fewer words, one hash of them all."""
    runs, sets = windows(hashes, size), []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= size:
            sets.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            few = np.uint64(b - a)
            for h in hashes[a:b]:
                few = mix(np.array([few + h], np.uint64))[0]
            sets.append(np.array([few], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
