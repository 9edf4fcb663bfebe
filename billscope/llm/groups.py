"""Groups of sorted rows streamed through a task one at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys in batches that are sorted by integer keys; a run may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(key).to_numpy(zero_copy_only=False) for key in keys], axis=1)
        cuts = [0, *(np.flatnonzero((columns[1:] != columns[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if last is not None and (columns[start] != last).any():
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = columns[start]
    if held:
        yield pa.Table.from_batches(held)
