"""Helpers for Arrow tasks: consecutive groups of sorted rows, and batches from columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Rows of a returned batch.
BATCH_ROWS = 20_000


def changes(batch: pa.RecordBatch, keys: int) -> np.ndarray:
    """Rows of a batch at which one of the first ``keys`` integer columns differs from the row before."""
    differs = np.zeros(max(0, batch.num_rows - 1), bool)
    for k in range(keys):
        values = batch.column(k).to_numpy(zero_copy_only=False)
        differs |= values[1:] != values[:-1]
    return np.flatnonzero(differs) + 1


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Rows in a row with equal values in the first ``keys`` (integer) columns, one batch for each group.

    The rows must be sorted by these columns. One group is held at a time.
    """
    open_parts: list[pa.RecordBatch] = []

    def key(batch, i):
        return tuple(batch.column(k)[i].as_py() for k in range(keys))

    for batch in batches:
        if not batch.num_rows:
            continue
        if open_parts and key(open_parts[-1], 0) != key(batch, 0):
            yield joined(open_parts)
            open_parts = []
        cuts = [0, *changes(batch, keys).tolist(), batch.num_rows]
        for i, j in zip(cuts[:-1], cuts[1:]):
            if i:
                yield joined(open_parts)
                open_parts = []
            open_parts.append(batch.slice(i, j - i))
    if open_parts:
        yield joined(open_parts)


def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Of the given links among 0..n-1, those that are enough to connect what all of them connect."""
    parent = list(range(n))
    kept = []
    for a, b in zip(left.tolist(), right.tolist()):
        x, y = a, b
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
            if len(kept) == n - 1:
                break
    return kept


class Rows:
    """Collects lists of column values and hands them out as batches of about ``BATCH_ROWS`` rows."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.columns, self.count = schema, [[] for _ in schema], 0

    def add(self, *columns) -> None:
        """Columns of equal length."""
        for known, new in zip(self.columns, columns):
            known.append(new)
        self.count += len(columns[0])

    def take(self, least: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
        """What has been added, if it is at least so many rows."""
        if self.count and self.count >= least:
            arrays = []
            for parts, field in zip(self.columns, self.schema):
                made = [pa.array(p, field.type) for p in parts]
                arrays.append(made[0] if len(made) == 1 else pa.concat_arrays(made))
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
            self.columns, self.count = [[] for _ in self.schema], 0
