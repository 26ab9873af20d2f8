"""Texts as one byte array: words, lines and 64-bit hashes of spans, computed for a whole Arrow batch at once.

A hash of a span is a polynomial over a random value for each byte, modulo 2**64, taken from prefix sums and then
mixed. Equal spans have equal hashes wherever they stand, also on other machines and in other runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 3
WORD_BASE = 0xD1342543DE82EF95 | 3

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit depends on every bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_VALUE = mixed(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


def powers(base: int, n: int) -> np.ndarray:
    """base**i for i below n."""
    t = np.full(max(n, 1), base & 0xFFFFFFFFFFFFFFFF, U64)
    t[0] = 1
    return np.cumprod(t, dtype=U64)


class Hashes:
    """Hashes of spans of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, base: int):
        self.down = powers(pow(base, -1, 1 << 64), values.size + 1)
        self.sums = np.zeros(values.size + 1, U64)
        np.cumsum(values * powers(base, values.size)[: values.size], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mixed(raw + (end - start).astype(U64) * U64(0xC2B2AE3D27D4EB4F))

    def windows(self, width: int) -> np.ndarray:
        """Of the spans of this width, by start."""
        n = self.sums.size - width
        if n <= 0:
            return np.zeros(0, U64)
        raw = (self.sums[width:] - self.sums[:n]) * self.down[:n]
        return mixed(raw + U64(width * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each text starts; one more entry for the end. Nulls are empty."""
    a = pc.fill_null(column, "").cast(pa.large_binary())
    a = a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a
    if isinstance(a, pa.ChunkedArray):
        a = pa.concat_arrays(a.chunks) if a.num_chunks else pa.array([], pa.large_binary())
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    data = a.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(a) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The texts in parts of about this many bytes (a longer text is one part): first, last + 1, bytes, offsets."""
    first, n = 0, offsets.size - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs of bytes that are inside; runs end with their text."""
    n = inside.size
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | cut[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | cut[1:n]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


class Words:
    """The words of texts (runs of other bytes than the six ASCII blanks).

    start, end: byte positions; first: index of each text's first word, with one more entry; doc: text of a word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.start, self.end = runs(~SPACE[data], offsets)
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(offsets.size - 1), np.diff(self.first))

    def hashes(self, data: np.ndarray) -> np.ndarray:
        return Hashes(BYTE_VALUE[data], BASE).spans(self.start, self.end)

    def windows(self, width: int) -> np.ndarray:
        """Index of the first word of every window that lies within one text."""
        n = self.doc.size - width + 1
        return np.flatnonzero(self.doc[:n] == self.doc[width - 1 :]) if n > 0 else np.zeros(0, np.int64)
