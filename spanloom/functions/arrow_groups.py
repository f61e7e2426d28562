"""Helpers for mapInArrow over partitions sorted by a key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def boundaries(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which a new key begins, 0 first; null equals null."""
    n = table.num_rows
    new = np.zeros(n, bool)
    if n:
        new[0] = True
    if n > 1:
        for key in keys:
            col = table[key].combine_chunks()
            a, b = col.slice(0, n - 1), col.slice(1)
            differ = pc.fill_null(pc.not_equal(a, b), False)
            nulls = pc.not_equal(pc.is_null(a), pc.is_null(b))
            new[1:] |= pc.or_(differ, nulls).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold only whole groups, from batches sorted by keys.

    A group that runs over several batches is held back until its last row came, so callers
    bound the size of a group before they sort (by a chunk number among the keys).
    """
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        starts = boundaries(table, keys)
        if held:
            edge = pa.concat_tables([held[-1].slice(held[-1].num_rows - 1), table.slice(0, 1)])
            if len(boundaries(edge, keys)) > 1:
                yield pa.concat_tables(held).combine_chunks()
                held = []
            elif len(starts) > 1:
                yield pa.concat_tables([*held, table.slice(0, int(starts[1]))]).combine_chunks()
                held, table = [], table.slice(int(starts[1]))
                starts = starts[1:] - starts[1]
        if not held and len(starts) > 1:
            yield table.slice(0, int(starts[-1])).combine_chunks()
            table = table.slice(int(starts[-1]))
        held.append(table)
    if held:
        yield pa.concat_tables(held).combine_chunks()
