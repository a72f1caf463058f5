"""Reading sorted Arrow batches by whole groups."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def group_starts(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """The first row of each run of equal keys; keys are whole numbers."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for key in keys:
        values = batch.column(key).to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches, sorted by ``keys``, again in batches that no group goes beyond.

    Each holds as many groups as ``most_bytes`` take, or one that is larger.
    """
    waiting: list[pa.RecordBatch] = []
    size, limit = 0, most_bytes
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        size += batch.nbytes
        if size >= limit:
            rows = pa.concat_batches(waiting)
            last = int(group_starts(rows, keys)[-1])
            if last:
                yield rows.slice(0, last)
                rows = rows.slice(last)
            waiting, size = [rows], rows.nbytes
            limit = max(most_bytes, 2 * size)
    if waiting:
        yield pa.concat_batches(waiting)
