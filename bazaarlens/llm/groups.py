"""Sorted rows of a task, one group at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def grouped(rows: DataFrame, *keys: str) -> DataFrame:
    """All rows of a key in one task, next to each other. Only for keys of bounded groups."""
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The groups of rows whose first ``keys`` columns (integers) agree; one group is held at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for k in range(keys):
            column = batch.column(k).to_numpy(zero_copy_only=False)
            change |= column[1:] != column[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        if held and any(held[0].column(k)[0] != batch.column(k)[0] for k in range(keys)):
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def fixed_width(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    """A column of equally long binary values as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), -1)
