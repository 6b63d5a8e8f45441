"""Arrow batches of a task: whole groups of a sorted partition, and slices of bounded bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Rows that begin a group of equal keys (nulls are equal), and the number of rows."""
    n = table.num_rows
    if not n:
        return np.zeros(1, np.int64)
    new = np.zeros(n - 1, bool)
    for key in keys:
        values = table.column(key).combine_chunks()
        if isinstance(values, pa.ChunkedArray):
            values = pa.concat_arrays(values.chunks)
        a, b = values.slice(0, n - 1), values.slice(1)
        gone_a, gone_b = np.asarray(pc.is_null(a)), np.asarray(pc.is_null(b))
        differ = np.asarray(pc.fill_null(pc.not_equal(a, b), False))
        new |= differ | (gone_a != gone_b)
    return np.concatenate([[0], np.flatnonzero(new) + 1, [n]])


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, starts) with no group cut: the last group of a batch waits for the next one. Rows come sorted by the keys.
    At most one group and one batch are held."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held:
            # A batch that lies within the held group only joins it.
            edge = starts(pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), batch]), keys)
            if len(edge) == 2:
                held.append(batch)
                continue
        table = pa.Table.from_batches([*held, batch])
        cuts = starts(table, keys)
        last = int(cuts[-2])
        if last:
            yield table.slice(0, last), cuts[:-1]
        held = table.slice(last).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, starts(table, keys)


def slices(batch: pa.RecordBatch, text: int, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of at most ``most`` bytes in the column numbered ``text``, one row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        begun = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, begun + most, side="right")))
        yield batch.slice(at, end - at)
        at = end
