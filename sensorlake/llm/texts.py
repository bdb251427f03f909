"""Texts as flat byte arrays: word spans and hashes of a whole Arrow batch at once.

A word is a maximal run of characters other than space and U+0009 to U+000D. All of these are single
bytes in UTF-8, and no other character holds such a byte, so words are found on the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WORD_BREAKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SLICE_BYTES = 2 << 20  # texts handled at once; a longer text is handled alone
_LONG_WORD = 1 << 12

_is_break = np.zeros(256, dtype=bool)
_is_break[list(WORD_BREAKS)] = True
_random = np.random.Generator(np.random.PCG64(20240229))
_byte_value = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_place_value = _random.integers(1, 1 << 63, _LONG_WORD, dtype=np.uint64)
_window_value = _random.integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_lower = np.arange(256, dtype=np.uint8)
_lower[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Texts:
    """Some texts of a batch: `data[offsets[i]:offsets[i + 1]]` are the UTF-8 bytes of text i."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lower(self) -> Texts:
        return Texts(_lower[self.data], self.offsets)


def flat(column: pa.Array) -> Texts:
    """An Arrow string column; NULL is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    if len(column) == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(texts: Texts, size: int = SLICE_BYTES) -> Iterator[tuple[int, Texts]]:
    """The texts in order, some at a time, with the index of the first."""
    start = 0
    while start < len(texts):
        last = np.searchsorted(texts.offsets, texts.offsets[start] + size, "right") - 1
        last = min(max(last, start + 1), len(texts))
        offsets = texts.offsets[start : last + 1]
        yield start, Texts(texts.data[offsets[0] : offsets[-1]], offsets - offsets[0])
        start = last


@dataclass
class Words:
    """`starts[j]:ends[j]` are the bytes of word j; text i has words `first[i]:first[i + 1]`."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(texts: Texts) -> Words:
    inside = ~_is_break[texts.data]
    if len(inside) == 0:
        return Words(*[np.zeros(0, np.int64)] * 2, np.zeros(len(texts) + 1, np.int64))
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes[:-1] &= ~inside[1:]
    cuts = texts.offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    begins[cuts] = inside[cuts]
    finishes[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, texts.offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes; spans are ascending and do not overlap."""
    lengths = ends - starts
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    before = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(before, lengths)
    at = place + np.repeat(starts, lengths)
    value = _byte_value[data[at]] * _place_value[place % _LONG_WORD]
    if len(place) and int(lengths.max()) > _LONG_WORD:
        value = mix(value + (place // _LONG_WORD).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    full = lengths > 0
    sums = np.zeros(len(starts), np.uint64)
    sums[full] = np.add.reduceat(value, before[full])
    return mix(sums + lengths.astype(np.uint64))


def window_hashes(values: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of every `size` consecutive values (index i: values i to i + size - 1)."""
    count = len(values) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for place in range(size):
        total += values[place : place + count] * _window_value[salt, place]
    return mix(total)


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Indices at which a window of `size` words lies within one text."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) - np.repeat(before - first[:-1], counts)


def covered(starts: np.ndarray, size: int, length: int) -> np.ndarray:
    """Which of `length` places lie in a window of `size` places from one of `starts`."""
    change = np.zeros(length + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + size, length), -1)
    return np.cumsum(change[:-1]) > 0


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices of consecutive runs: `starts[i]`, ..., `starts[i] + counts[i] - 1` for each i."""
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - before, counts)
