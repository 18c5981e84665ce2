"""Elias-Fano coding of rising sequences, with access and successor search on whole arrays of questions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Values of ``width`` bits (below 57) one behind the other, as bytes with eight spare ones at the end."""
    out = np.zeros(len(values) * width // 8 + 9, np.uint8)
    places = np.arange(width, dtype=np.uint64)
    for i in range(0, len(values) if width else 0, 1 << 16):
        bits = ((values[i : i + (1 << 16), None] >> places) & np.uint64(1)).astype(np.uint8)
        packed = np.packbits(bits.reshape(-1), bitorder="little")
        out[i * width // 8 : i * width // 8 + len(packed)] = packed
    return out


def read_bits(packed: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(at), np.uint64)
    bit = at * width
    words = np.ndarray(len(packed) - 7, "<u8", packed, strides=(1,))  # the eight bytes from each byte on
    return (words[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)


@dataclass
class EliasFano:
    """A sequence that never falls: low bits as they are, high bits in unary with zeros as separators of equal high parts."""

    n: int
    width: int
    low: np.ndarray
    high: np.ndarray  # bits in 64-bit words
    zeros: np.ndarray  # zeros before each word
    high_parts: int

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> "EliasFano":
        values = values.astype(np.uint64)
        n = len(values)
        width = min(56, max(0, (max(int(universe), 1) // max(n, 1)).bit_length() - 1))
        high = (values >> np.uint64(width)).astype(np.int64)
        parts = (max(int(universe), 1) >> width) + 1
        bits = np.zeros((n + parts + 64) // 64 * 64, np.uint8)
        bits[high + np.arange(n)] = 1
        bits[n + parts :] = 1
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        return EliasFano.opened(n, width, pack_bits(values & np.uint64((1 << width) - 1), width), words, parts)

    @staticmethod
    def opened(n: int, width: int, low: np.ndarray, words: np.ndarray, parts: int) -> "EliasFano":
        zeros = np.concatenate(([0], np.cumsum(64 - np.bitwise_count(words).astype(np.int64))))
        return EliasFano(n, width, low, words, zeros, parts)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Place of the zero number k (from 0)."""
        word = np.searchsorted(self.zeros, k, "right") - 1
        rest, bits = k - self.zeros[word], ~self.high[word]
        place = np.zeros(len(k), np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            part = np.bitwise_count(bits & np.uint64((1 << step) - 1)).astype(np.int64)
            up = rest >= part
            rest = np.where(up, rest - part, rest)
            place += np.where(up, step, 0)
            bits = np.where(up, bits >> np.uint64(step), bits)
        return word * 64 + place

    def bucket(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Elements with a high part: from, to."""
        end = self._zero(high) - high
        begin = np.where(high > 0, self._zero(np.maximum(high - 1, 0)) - np.maximum(high - 1, 0), 0)
        return begin, end

    def _search(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the first element that is not smaller, the end of the elements with the same high part, and the low part."""
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        beyond = high >= self.high_parts
        low, (begin, end) = values & np.uint64((1 << self.width) - 1), self.bucket(np.where(beyond, 0, high))
        begin[beyond] = end[beyond] = self.n
        last = end.copy()
        while len(open_ := np.flatnonzero(begin < end)):
            middle = (begin[open_] + end[open_]) // 2
            less = read_bits(self.low, self.width, middle) < low[open_]
            begin[open_[less]] = middle[less] + 1
            end[open_[~less]] = middle[~less]
        return begin, last, low

    def successor(self, values: np.ndarray) -> np.ndarray:
        """Place of the first element that is not smaller than each value; ``n`` if there is none."""
        return self._search(values)[0]

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value, -1 if it is not there."""
        at, last, low = self._search(values)
        inside = np.flatnonzero(at < last)
        hit = inside[read_bits(self.low, self.width, at[inside]) == low[inside]]
        found = np.full(len(at), -1, np.int64)
        found[hit] = at[hit]
        return found

    def all(self) -> np.ndarray:
        bits = np.unpackbits(np.ascontiguousarray(self.high).view(np.uint8), bitorder="little")
        ones = np.flatnonzero(bits)[: self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64)
        return (high << np.uint64(self.width)) | read_bits(self.low, self.width, np.arange(self.n))
