"""Groups of consecutive equal keys in a stream of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], at_least: int = 1
) -> Iterator[pa.Table]:
    """Rows with equal keys together, for input sorted by integer keys without nulls.

    Only the group that is open at the end of a batch is held; groups of fewer than
    ``at_least`` rows are passed over without being cut out.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        changed = np.zeros(table.num_rows - 1, dtype=bool)
        for key in keys:
            column = table.column(key).to_numpy()
            changed |= column[1:] != column[:-1]
        edges = np.concatenate([[0], np.flatnonzero(changed) + 1])
        sizes = np.diff(edges)
        for group in np.flatnonzero(sizes >= at_least):
            yield table.slice(edges[group], sizes[group])
        held = table.slice(edges[-1]).to_batches()
    if held:
        last = pa.Table.from_batches(held)
        if last.num_rows >= at_least:
            yield last


