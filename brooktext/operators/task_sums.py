"""Sums of NumPy arrays over the tasks of a frame, added up in a tree."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SUMS = "name string, vector array<double>"
SCHEMA = pa.schema([("name", pa.string()), ("vector", pa.list_(pa.float64()))])

# What a task makes of its rows: named arrays of the model's size.
Local = Callable[[Iterator[pa.RecordBatch]], dict[str, np.ndarray]]


def _batch(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
    vectors = [np.asarray(v, dtype=np.float64).ravel() for v in sums.values()]
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in vectors]))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(vectors)))
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), lists], schema=SCHEMA)


def _add(total: dict[str, np.ndarray], names: list[str], lists: pa.ListArray) -> None:
    flat, lengths = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
    for name, part in zip(names, np.split(flat, np.cumsum(lengths)[:-1]), strict=True):
        total[name] = total[name] + part if name in total else part


def task_sums(rows: DataFrame, local: Local) -> dict[str, np.ndarray]:
    """The arrays that ``local`` returns for each task, added by name, flat; none without rows.

    Tasks send their arrays to about the square root of as many, and only
    those sums reach the driver.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = local(batch for batch in batches if batch.num_rows)
        if sums:
            yield _batch(sums)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            _add(total, batch.column("name").to_pylist(), batch.column("vector"))
        if total:
            yield _batch(total)

    few = max(1, math.isqrt(tasks))
    table = rows.mapInArrow(each, SUMS).repartition(few).mapInArrow(added, SUMS).toArrow()
    total: dict[str, np.ndarray] = {}
    for batch in table.to_batches():
        _add(total, batch.column("name").to_pylist(), batch.column("vector"))
    return total
