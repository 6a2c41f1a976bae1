"""Sums of NumPy arrays over all rows: one array per task, added up in a tree."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: task arrays that the driver adds itself
_DIRECT = 64
#: size of a block of rows that a task computes at once, for one matrix
_BLOCK_BYTES = 8 * 1024 * 1024


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The rows of an array<double> column, none of them null, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dim)


def blocks(n: int, width: int) -> Iterator[slice]:
    """0..n in slices whose rows, ``width`` doubles each, take about 8 MB: what a task
    computes from a batch follows from the block, not from the batch."""
    step = max(64, _BLOCK_BYTES // (8 * max(1, width)))
    return (slice(i, min(i + step, n)) for i in range(0, n, step))


def sum_over(df: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray], tasks: int) -> np.ndarray:
    """The sum of ``partial`` (a 1-d float array of fixed length) over the tasks of
    ``df``, of which there are ``tasks``. Up to 64 arrays go to the driver; of more,
    about their square root, each the sum of as many in a task of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = np.asarray(partial(batches), dtype=np.float64)
        bucket = TaskContext.get().partitionId() % max(1, math.isqrt(tasks))
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([v.tobytes()], pa.binary())], ["bucket", "v"])

    def add(table: pa.Table) -> pa.Table:
        v = sum(np.frombuffer(x, dtype=np.float64) for x in table.column("v").to_pylist())
        return pa.table({"v": pa.array([v.tobytes()], pa.binary())})

    parts = df.mapInArrow(run, "bucket int, v binary")
    if tasks > _DIRECT:
        parts = parts.groupBy("bucket").applyInArrow(add, "v binary")
    return sum(np.frombuffer(bytes(r["v"]), dtype=np.float64) for r in parts.select("v").collect())
