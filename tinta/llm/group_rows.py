"""Bounded groups inside the partitions of an Arrow map, and what is done with the links found in one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """The rows of one combination of integer keys after the other, from rows sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in keys])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for b, e in zip(cuts[:-1], cuts[1:]):
            name = tuple(key[:, b].tolist())
            if held and name != last:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            held.append(batch.slice(b, e - b))
            last = name
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def forest(a: np.ndarray, b: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every member to the smallest member of its component."""
    label = np.arange(m)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            at = np.flatnonzero(label != np.arange(m))
            return at, label[at]
        label = new
