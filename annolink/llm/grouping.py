"""Whole groups out of sorted batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def groups(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[pa.Table]:
    """Whole groups of a stream of batches sorted by an integer key, as tables of some size."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        last = int(np.searchsorted(keys, keys[-1]))
        if kept and kept[-1].column(key)[-1].as_py() != keys[0] or last:
            yield pa.Table.from_batches([*kept, batch.slice(0, last)])
            kept = [batch.slice(last)]
        else:
            kept.append(batch)
    if kept:
        yield pa.Table.from_batches(kept)
