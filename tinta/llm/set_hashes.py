"""Sets of word shingles of Arrow text columns as sorted 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tinta.llm.byte_words import ALPHANUMERIC, _mix, find_words, runs_of_rows

STEP = 0x9E3779B97F4A7C15


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Per text, the sorted different hashes of its runs of ``size`` words; a shorter text with words is one shingle."""
    for first, last in runs_of_rows(column):
        yield from _sets_of_run(column.slice(first, last - first), size)


def _sets_of_run(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    words = find_words(column, ALPHANUMERIC)
    hashes, counts = words.hashes(), words.counts.tolist()
    scale = np.array([pow(STEP, k, 1 << 64) for k in range(size)], np.uint64)
    n = len(hashes) - size + 1
    runs = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        runs += hashes[k : k + n] * scale[k]
    runs = _mix(runs)
    for first, count in zip(words.first.tolist(), counts):
        if count >= size:
            yield np.unique(runs[first : first + count - size + 1])
        elif count:
            short = hashes[first : first + count]
            yield _mix((short * scale[:count]).sum(keepdims=True, dtype=np.uint64) + np.uint64(count))
        else:
            yield np.zeros(0, np.uint64)


def set_digest(tokens: np.ndarray) -> bytes:
    """128 bits that name a set."""
    low = _mix(tokens).sum(dtype=np.uint64)
    high = _mix(tokens ^ np.uint64(STEP)).sum(dtype=np.uint64)
    return int(low).to_bytes(8, "little") + int(high).to_bytes(8, "little")
