"""Streaming over the groups of a sorted partition in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def group_chunks(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows in chunks that end where a group ends, with the places at which groups begin.

    The input is sorted by ``keys``, which have no nulls; the last entry is the number of rows.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        first = [batch.column(k)[0] for k in keys]
        last = [batch.column(k)[-1] for k in keys]
        if first == last and (len(held) == 1 or [held[-2].column(k)[-1] for k in keys] == last):
            continue  # the whole batch may belong to a group that goes on
        table = pa.Table.from_batches(held)
        begins = starts(table, *keys)
        cut = int(begins[-2])
        yield table.slice(0, cut).combine_chunks(), begins[:-1]
        held = table.slice(cut).to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, starts(table, *keys)


def starts(table: pa.Table, *keys: str) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in keys:
        column = table[k]
        if table.num_rows > 1:
            new[1:] |= np.asarray(pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)))
    return np.append(np.flatnonzero(new), table.num_rows)


def settled(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least member of each element's component, given links between elements."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        np.minimum.at(label, before[left], low)
        np.minimum.at(label, before[right], low)
        label = label[label]
        if (label == before).all():
            break
    return label
