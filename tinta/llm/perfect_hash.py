"""Minimal perfect hashing of 64-bit keys: levels of bits with ranks, built per bucket, with the keys beside them for verification.

A bucket's keys are hashed into the bits of its first level; a key that is alone on its bit is placed there, the others go on to the next level.
The number of set bits before a key's bit is its number, so ``n`` keys get the numbers ``0 .. n - 1``, and a key that was never placed is told by comparison.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tinta.llm.byte_words import _mix

SPACE = 1.5
SPREAD = np.uint64(0xA0761D6478BD642F)


def _seed(level: int) -> np.uint64:
    return np.uint64((level + 1) * 0xE7037ED1A0B428DB % (1 << 64))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (_mix(keys ^ SPREAD) % np.uint64(buckets)).astype(np.int64)


def build_bucket(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Words (of 64 bits) per level, the bits of all levels, and the different ``keys`` in the order of their numbers."""
    left, sizes, words, order = keys, [], [], []
    while len(left):
        size = max(1, -(-int(len(left) * SPACE) // 64))
        at = (_mix(left ^ _seed(len(sizes))) % np.uint64(64 * size)).astype(np.int64)
        alone = np.bincount(at, minlength=64 * size)[at] == 1
        held = at[alone]
        bits = np.zeros(64 * size, np.uint8)
        bits[held] = 1
        words.append(np.packbits(bits, bitorder="little").view(np.uint64))
        order.append(left[alone][np.argsort(held)])
        sizes.append(size)
        left = left[~alone]
    if not sizes:
        return [], np.zeros(0, np.uint64), keys
    return sizes, np.concatenate(words), np.concatenate(order)


@dataclass
class PerfectHash:
    """Neighbouring buckets ``first_bucket ..`` of ``buckets``, put together."""

    buckets: int
    first_bucket: int
    sizes: np.ndarray  # words of each bucket and level
    begin: np.ndarray  # first word of each bucket and level
    words: np.ndarray
    before: np.ndarray  # set bits before each word
    keys: np.ndarray

    @classmethod
    def joined(cls, buckets: int, first_bucket: int, parts: list[tuple[list[int], np.ndarray, np.ndarray]]) -> PerfectHash:
        deep = max((len(p[0]) for p in parts), default=0)
        sizes = np.array([[*p[0], *[0] * (deep - len(p[0]))] for p in parts], np.int64).reshape(len(parts), deep)
        begin = np.cumsum(sizes.reshape(-1)).reshape(sizes.shape) - sizes
        words = np.concatenate([np.zeros(0, np.uint64), *[p[1] for p in parts]])
        before = np.cumsum(np.bitwise_count(words).astype(np.int64)) - np.bitwise_count(words)
        return cls(buckets, first_bucket, sizes, begin, words, before, np.concatenate([np.zeros(0, np.uint64), *[p[2] for p in parts]]))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 for keys that are not here."""
        out = np.full(len(keys), -1, np.int64)
        bucket = bucket_of(keys, self.buckets) - self.first_bucket
        left = np.flatnonzero((bucket >= 0) & (bucket < len(self.sizes)))
        for level in range(self.sizes.shape[1]):
            size = self.sizes[bucket[left], level]
            left, size = left[size > 0], size[size > 0]
            if not len(left):
                break
            at = (_mix(keys[left] ^ _seed(level)) % (size * 64).astype(np.uint64)).astype(np.int64)
            word, bit = self.begin[bucket[left], level] + (at >> 6), (at & 63).astype(np.uint64)
            held = self.words[word]
            here = (held >> bit) & np.uint64(1) == 1
            below = held & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[here]] = (self.before[word] + np.bitwise_count(below))[here]
            left = left[~here]
        known = np.flatnonzero(out >= 0)
        out[known[self.keys[out[known]] != keys[known]]] = -1
        return out
