"""Words of Arrow text columns as numpy arrays: spans of bytes and 64-bit hashes, without a Python object per word.

Word classes here are defined by ASCII bytes alone; every byte from 0x80 on belongs to a word, so UTF-8 needs no decoding.
Two different words share a hash with probability 2**-64, about V*V / 2**65 for V different words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tinta.session import small_batches as small_batches

CHUNK = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15 | 5)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the output (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


# A value per byte; capital letters have the value of the small ones.
LOWER = np.arange(256)
LOWER[65:91] += 32
VALUES = _mix((LOWER.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
EXACT_VALUES = _mix((np.arange(256, dtype=np.uint64) + np.uint64(257)) * np.uint64(0x9E3779B97F4A7C15))
_powers = {}


def powers(base: int, length: int) -> np.ndarray:
    """base**0 .. base**(length-1) modulo 2**64."""
    held = _powers.get(base)
    if held is None or len(held) < length:
        factors = np.full(max(length, CHUNK + 1), base, np.uint64)
        factors[0] = 1
        held = np.cumprod(factors, dtype=np.uint64)
        if length <= CHUNK + 1:
            _powers[base] = held
    return held[:length]


def byte_class(pattern_bytes: set[int]) -> np.ndarray:
    """Table of 256: whether a byte belongs to a word."""
    table = np.zeros(256, bool)
    table[list(pattern_bytes)] = True
    return table


#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z
ALPHANUMERIC = byte_class({*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)})
#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = byte_class(set(range(256)) - {32, *range(9, 14)})


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins and ends; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    return whole[first : int(offsets[-1])], offsets - first


def runs_of_rows(column: pa.Array, most_bytes: int = 1 << 20) -> list[tuple[int, int]]:
    """First row and end of runs of texts of a bounded size, so that what is worked out for a run stays small; a longer text is a run alone."""
    offsets, first, runs = text_bytes(column)[1], 0, []
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most_bytes, "right")) - 1)
        runs.append((first, last))
        first = last
    return runs


@dataclass
class Words:
    """Words of a batch of texts, in order. ``first[i]:first[i + 1]`` are the words of text i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def texts(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def word(self, i: int) -> str:
        """A word with A-Z in lower case."""
        return LOWER[self.data[self.starts[i] : self.ends[i]]].astype(np.uint8).tobytes().decode("utf-8", "replace")


def find_words(column: pa.Array, inside: np.ndarray) -> Words:
    """Maximal runs of bytes of a class in each text."""
    data, offsets = text_bytes(column)
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64))
    held = inside[data]
    change = np.flatnonzero(held[1:] != held[:-1]) + 1
    ends = [0] if held[0] else []
    edges = np.concatenate((ends, change, [len(data)] if held[-1] else [])).astype(np.int64)
    border = np.unique(offsets[1:-1])
    border = border[(border > 0) & (border < len(data))]
    cut = border[held[border] & held[border - 1]]
    if len(cut):  # texts lie one behind the other: a word ends at the border and another begins
        edges = np.sort(np.concatenate((edges, cut, cut)), kind="stable")
    starts, stops = edges[0::2], edges[1::2]
    return Words(data, starts, stops, np.searchsorted(starts, offsets, "left"))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = VALUES) -> np.ndarray:
    """64-bit hash of each span; the bytes are summed with powers of an odd base, in bounded chunks."""
    out = np.empty(len(starts), np.uint64)
    inverse = _inverse(int(BASE))
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + CHUNK, "right")))
        piece = data[base : int(ends[j - 1])]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(values[piece] * powers(int(BASE), len(piece)), out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        back = powers(inverse, int(s[-1]) + 1)[s]
        out[i:j] = (sums[e] - sums[s]) * back + (e - s).astype(np.uint64)
        i = j
    return _mix(out)


def place_in(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in a sorted array, -1 where it is not there."""
    if not len(ordered):
        return np.full(len(values), -1, np.int64)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return np.where(ordered[at] == values, at, -1)
