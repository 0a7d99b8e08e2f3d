"""Whole texts as numpy arrays: UTF-8 bytes with offsets, words, and hashes of spans from prefix sums.

A span hash is a polynomial over 64-bit values modulo 2**64, taken from prefix sums and mixed at the end, so that the
hash of every window of a text costs a few array operations, whatever the width of the window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are turned into byte-level arrays at once; a longer single text is taken alone.
STEP_BYTES = 512 << 10


def utf8(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and their offsets; null is empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], column.type)
    array = array.cast(pa.large_string()).fill_null("")
    _, offsets, data = array.buffers()
    ends = np.frombuffer(offsets, np.int64, len(array) + 1 + array.offset)[array.offset :] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def steps(offsets: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most so many bytes, at least one text each."""
    low, last = 0, len(offsets) - 1
    while low < last:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1)
        yield low, high
        low = high


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits evenly (finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SpanHash:
    """Hashes of spans of a sequence of 64-bit values; equal spans have equal hashes wherever they stand."""

    def __init__(self, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.base = int(rng.integers(0, 1 << 61)) * 8 + 3
        self.inverse = pow(self.base, -1, 1 << 64)
        self.of_byte = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.powers) < n:
            for name, base in (("powers", self.base), ("inverses", self.inverse)):
                factors = np.full(n + n // 4, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=np.uint64))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        n = len(values)
        self.grow(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.powers[:n], out=sums[1:])
        return sums

    def prefix_of_bytes(self, raw: np.ndarray) -> np.ndarray:
        return self.prefix(self.of_byte[raw])

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lengths = (ends - starts).astype(np.uint64)
        return mix((sums[ends] - sums[starts]) * self.inverses[starts] + lengths * np.uint64(0x9E3779B97F4A7C15))

    def rolling(self, sums: np.ndarray, width: int) -> np.ndarray:
        """Hashes of all spans of this width, in order."""
        n = len(sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((sums[width:] - sums[:n]) * self.inverses[:n])


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)


def is_space(raw: np.ndarray) -> np.ndarray:
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word of the texts, and the offsets of the texts in these."""
    n = len(raw)
    inside = ~is_space(raw)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(
    raw: np.ndarray, offsets: np.ndarray, hashes: list[SpanHash], lower: bool = False
) -> tuple[list[np.ndarray], np.ndarray]:
    """For each hash the values of all words, and the offsets of the texts in these."""
    found: list[list[np.ndarray]] = [[] for _ in hashes]
    at, total = [np.zeros(1, np.int64)], 0
    for low, high in steps(offsets):
        part = raw[offsets[low] : offsets[high]]
        part = lowered(part) if lower else part
        starts, ends, words = word_spans(part, offsets[low : high + 1] - offsets[low])
        for into, h in zip(found, hashes, strict=True):
            into.append(h.spans(h.prefix_of_bytes(part), starts, ends))
        at.append(words[1:] + total)
        total += len(starts)
    return [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in found], np.concatenate(at)


def fits(offsets: np.ndarray, width: int) -> np.ndarray:
    """For every place of the sequences whether a window of this width starts there and stays in its sequence."""
    n = int(offsets[-1])
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)
    return left >= width


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n places lie in a window of this width at one of these starts."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.cumsum(change[:-1]) > 0
