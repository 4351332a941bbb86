"""Words of whole texts as spans and 64-bit hashes, computed on Arrow buffers without a loop per word.

A word is a run of bytes other than space and 0x09-0x0D; in UTF-8 that is the same as the character
class ``[^\\x20\\x09-\\x0D]+``. A null text is an empty one. Hashes do not depend on the process, so
they can be shuffled. Batches are worked through in pieces of at most ``PIECE`` bytes (or one text),
which bounds the memory of a task whatever a text's length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _BASE + np.uint64(salt)) | np.uint64(1)


_BYTE = seeds(256, 77)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_GRAM = seeds(64, 1234)


class _Powers:
    """Powers of the base and of its inverse, grown as longer pieces come."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, PIECE)
            base = np.full(size, _BASE)
            inverse = np.full(size, np.uint64(pow(int(_BASE), -1, 1 << 64)))
            base[0] = inverse[0] = 1
            cls.up, cls.down = np.multiply.accumulate(base), np.multiply.accumulate(inverse)
        return cls.up, cls.down


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """Polynomial hashes of byte spans, whatever their place; ``lower`` equates A-Z with a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _Powers.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER if lower else _BYTE)[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


@dataclass
class Piece:
    """Some texts of a batch: rows [first, first + n), their bytes and their words."""

    first: int
    n: int
    data: np.ndarray
    offsets: np.ndarray  # n + 1 places in data
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # n + 1 places in starts

    def hashes(self, lower: bool = True) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, lower)

    def grams(self, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``k`` words within a text, and the n + 1 bounds of each text's."""
        counts = np.maximum(np.diff(self.bounds) - (k - 1), 0)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        whole = gram_hash(words, k)
        keep = np.repeat(self.bounds[:-1] - bounds[:-1], counts) + np.arange(bounds[-1])
        return whole[keep], bounds


def gram_hash(words: np.ndarray, k: int) -> np.ndarray:
    n = max(len(words) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += words[j : j + n] * _GRAM[j]
    return mix(out + np.uint64(k))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and each text's bounds among them."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    first, last = ~space, ~space
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    inner = offsets[:-1][np.diff(offsets) > 0]
    first[inner] = ~space[inner]
    ends = offsets[1:][np.diff(offsets) > 0] - 1
    last[ends] = ~space[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[Piece]:
    """The texts of a column, about a megabyte at a time."""
    data, offsets = buffers(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        part = data[offsets[first] : offsets[last]]
        places = offsets[first : last + 1] - offsets[first]
        yield Piece(first, last - first, part, places, *spans(part, places))
        first = last


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of runs of 64-bit values, whatever their place."""
    up, down = _Powers.of(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def lines(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and owner of every line with at least one byte, split at line feeds."""
    feeds = np.flatnonzero(piece.data == 10)
    starts = np.unique(np.concatenate([piece.offsets[:-1], feeds + 1]))
    starts = starts[starts < len(piece.data)]
    owner = np.searchsorted(piece.offsets, starts, "right") - 1
    stops = np.append(feeds, len(piece.data))
    ends = np.minimum(stops[np.searchsorted(stops, starts)], piece.offsets[owner + 1])
    return starts, ends, owner


def sums_of(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between consecutive bounds."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]
