"""Runs of equal keys in sorted Arrow batches, read as a stream.

The rows of a partition come sorted by key, so rows that share a key follow each other, over any
number of batches. Only the last row and the first row of the current run are remembered: a key
that very many rows share takes no more memory than any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def _columns(batch: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def shared_keys(batches: Iterator[pa.RecordBatch], keys: list[str]
                ) -> Iterator[pa.RecordBatch]:
    """The rows whose key at least one other row has."""
    last: pa.RecordBatch | None = None         # last row so far, if it is still undecided
    last_key: tuple | None = None
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        values = _columns(batch, keys)
        as_before = np.ones(rows, bool)
        as_before[0] = last_key is not None and all(v[0] == k for v, k in zip(values, last_key))
        for v in values:
            as_before[1:] &= v[1:] == v[:-1]
        if last is not None and as_before[0]:
            yield last
        shared = as_before.copy()
        shared[:-1] |= as_before[1:]
        yield batch.filter(pa.array(shared))
        last = None if shared[-1] else batch.slice(rows - 1, 1)
        last_key = tuple(v[-1] for v in values)


def later_rows(batches: Iterator[pa.RecordBatch], keys: list[str], places: list[str]
               ) -> Iterator[pa.RecordBatch]:
    """The rows at another place than the first row with their key."""
    key: tuple | None = None
    first: tuple | None = None
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        values, where = _columns(batch, keys), _columns(batch, places)
        begins = np.zeros(rows, bool)
        begins[0] = key is None or any(v[0] != k for v, k in zip(values, key))
        for v in values:
            begins[1:] |= v[1:] != v[:-1]
        at = np.maximum.accumulate(np.where(begins, np.arange(rows), -1))
        carried = at < 0
        differs = np.zeros(rows, bool)
        for k, w in enumerate(where):
            reference = w[np.maximum(at, 0)]
            if carried.any():
                reference = np.where(carried, first[k], reference)
            differs |= w != reference
        yield batch.filter(pa.array(differs))
        key = tuple(v[-1] for v in values)
        if at[-1] >= 0:
            first = tuple(w[at[-1]] for w in where)
