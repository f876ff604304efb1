"""Words and shingles of a whole Arrow column at once, as 64-bit hashes, with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that are scanned at once; a longer text is scanned alone.
PIECE = 1 << 20

_random = np.random.default_rng(20240607)
_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEPS = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = _lowered()


def byte_class(*outside: tuple[int, int]) -> np.ndarray:
    """The bytes that belong to words: all, after A-Z became a-z, but for the ranges ``outside``."""
    inside = np.ones(256, bool)
    for first, last in outside:
        inside[first : last + 1] = False
    return inside[LOWER]


#: Words are what stands between blanks.
BLANK_SEPARATED = byte_class((0x09, 0x0D), (0x20, 0x20))
#: Words are letters, digits and whatever is not ASCII.
ALPHANUMERIC = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of some texts: hash, place in ``data``, and for each text its first word."""

    data: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # one more than there are texts

    def text_of(self) -> np.ndarray:
        """The number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return LOWER[self.data[self.starts[i] : self.ends[i]]].tobytes()


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset of each text; null is empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    offsets = offsets.astype(np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    """All words, lower-cased (A-Z), hashed.

    A word's hash is made of the sum of one mixed number for each byte and its place. Each of these is as good as drawn
    at random, so no pattern of letters makes two words alike, as it would in a polynomial modulo 2^64.
    """
    n = len(data)
    within = inside[data]
    edges = np.zeros(n + 1, bool)
    edges[offsets] = True
    begin = within.copy()
    begin[1:] &= ~within[:-1] | edges[1:n]
    last = within.copy()
    last[:-1] &= ~within[1:] | edges[1:n]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(last) + 1
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(data, np.zeros(0, np.uint64), starts, ends, first)
    lengths = ends - starts
    where = np.cumsum(lengths) - lengths
    place = (np.arange(int(lengths.sum())) - np.repeat(where, lengths)).astype(np.uint64)
    terms = mixed(_VALUES[LOWER[data[within]]] + place * _BASE)
    sums = np.add.reduceat(terms, where)
    return Words(data, mixed(sums + lengths.astype(np.uint64)), starts, ends, first)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each ``size`` consecutive words, texts not regarded."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, size, np.uint64) * _STEPS[63]
    for i in range(size):
        total += hashes[i : i + n] * _STEPS[i]
    return mixed(total)


def pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``PIECE`` bytes: number of the first, bytes, offsets."""
    data, offsets = texts(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + PIECE, "right")) - 1
        to = min(n, max(to, at + 1))
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to
