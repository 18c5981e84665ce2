"""FM-index over a sequence of word numbers: suffix order, wavelet matrix ranks, sampled suffix positions."""

from __future__ import annotations

import numpy as np


def suffix_order(sequence: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling. The sequence ends in its only smallest symbol."""
    n = len(sequence)
    _, rank = np.unique(sequence, return_inverse=True)
    order, length = np.argsort(rank, kind="stable"), 1
    while True:
        following = np.zeros(n, np.int64)
        following[: max(0, n - length)] = rank[length:] + 1
        key = rank.astype(np.int64) * (n + 1) + following
        order = np.argsort(key, kind="stable")
        steps = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank = np.empty(n, np.int64)
        rank[order] = steps
        if steps[-1] == n - 1:
            return order
        length *= 2


class Bits:
    """A bit vector with rank in two steps: a count per 64 bits, then the bits of one word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))))

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels: list[tuple[Bits, int]] = []
        self.depth = max(1, int(symbols - 1).bit_length())
        for level in range(self.depth - 1, -1, -1):
            bit = ((sequence >> level) & 1).astype(bool)
            self.levels.append((Bits(bit), int((~bit).sum())))
            sequence = np.concatenate((sequence[~bit], sequence[bit]))

    def rank(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands among the first i symbols."""
        low, high = np.zeros_like(i), i
        for level, (bits, zeros) in zip(range(self.depth - 1, -1, -1), self.levels):
            one = ((symbols >> level) & 1).astype(bool)
            low_ones, high_ones = bits.ones(low), bits.ones(high)
            low = np.where(one, zeros + low_ones, low - low_ones)
            high = np.where(one, zeros + high_ones, high - high_ones)
        return high - low

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before it."""
        symbol, low = np.zeros_like(i), np.zeros_like(i)
        for bits, zeros in self.levels:
            one, ones, low_ones = bits.get(i), bits.ones(i), bits.ones(low)
            symbol = symbol * 2 + one
            i = np.where(one, zeros + ones, i - ones)
            low = np.where(one, zeros + low_ones, low - low_ones)
        return symbol, i - low


class FMIndex:
    """Index of a sequence of numbers from 1 on; 0 may stand in it as a border that no phrase crosses."""

    def __init__(self, sequence: np.ndarray, symbols: int, sample: int = 8):
        text = np.concatenate((sequence.astype(np.int64) + 1, [0]))
        order = suffix_order(text)
        last = text[order - 1]
        self.wavelet = WaveletMatrix(last, symbols + 1)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols + 1))))
        sampled = order % sample == 0
        self.sampled, self.positions = Bits(sampled), order[sampled]
        self.size = len(text)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``low:high`` of the suffix order that begin with each phrase (one per row, equal lengths)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        for step in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[:, step].astype(np.int64) + 1
            low = self.before[symbol] + self.wavelet.rank(symbol, low)
            high = self.before[symbol] + self.wavelet.rank(symbol, high)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of rows of the suffix order: back through the text to a sampled place."""
        found = np.full(len(rows), -1, np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            hit = self.sampled.get(rows)
            found[open_[hit]] = self.positions[self.sampled.ones(rows[hit])] + steps
            open_, rows = open_[~hit], rows[~hit]
            symbol, before = self.wavelet.access(rows)
            rows = self.before[symbol] + before
            steps += 1
        return found
