"""State by key over a stream, updated by any function, on RocksDB; keys can expire.

The function sees the new rows of one key and its state so far and returns the
new state. Spark keeps the states in its checkpointed RocksDB store, one row a
key, off the heap, and hands each micro-batch only the keys it holds. Rows of
a key come in Arrow batches, so a hot key is never a list in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from brooktext.streaming.lifecycle import BatchRun

PROVIDER_SETTING = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# From the state of a key (None for a new one) and a part of its new rows to its next state, a tuple of the state's fields.
Update = Callable[[tuple | None, pd.DataFrame], tuple]


class KeyedState(StatefulProcessor):
    """Applies ``update`` to each key; emits a key's state when rows change it and when it expires."""

    def __init__(self, update: Update, state: T.StructType, time: str | None, expire_ms: int | None):
        self.update, self.state_type = update, state
        self.time, self.expire_ms = time, expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.state_type)
        self.deadline = handle.getValueState("deadline", "at bigint") if self.expire_ms is not None else None

    def _row(self, key: tuple, state: tuple, expired: bool) -> pd.DataFrame:
        return pd.DataFrame([(*key, *state, expired)])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self.state.get() if self.state.exists() else None
        latest = None
        for part in rows:
            state = self.update(state, part)
            if self.time is not None and len(part):
                last = int(part[self.time].max().timestamp() * 1000)
                latest = last if latest is None else max(latest, last)
        if state is None:
            return
        self.state.update(tuple(state))
        if self.expire_ms is not None:
            now = latest if self.time is not None else timerValues.getCurrentProcessingTimeInMs()
            before = self.deadline.get()[0] if self.deadline.exists() else None
            at = now + self.expire_ms if before is None else max(before, now + self.expire_ms)
            if at != before:
                if before is not None:
                    self.handle.deleteTimer(before)
                self.handle.registerTimer(at)
                self.deadline.update((at,))
        yield self._row(key, tuple(state), False)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            yield self._row(key, tuple(self.state.get()), True)
        self.state.clear()
        self.deadline.clear()

    def close(self) -> None:
        pass


def running_state(
    rows: DataFrame, keys: list[str], update: Update, state: str | T.StructType,
    time: str | None = None, expire_ms: int | None = None,
) -> DataFrame:
    """``keys``, the fields of ``state`` and ``expired``: a row for each key of each micro-batch.

    With ``expire_ms``, a key without rows for so long is emitted once more,
    ``expired``, and forgotten; a later row starts it anew. Time is the column
    ``time``, which needs a watermark on ``rows``, or the clock without it. Null
    keys are a key of their own.
    """
    fields = state if isinstance(state, T.StructType) else T.StructType.fromDDL(state)
    clash = {*keys, "expired"} & {field.name for field in fields}
    if clash:
        raise ValueError(f"state fields named like keys: {sorted(clash)}")
    output = T.StructType([rows.schema[key] for key in keys] + fields.fields + [T.StructField("expired", T.BooleanType())])
    mode = "None" if expire_ms is None else "EventTime" if time else "ProcessingTime"
    processor = KeyedState(update, fields, time, expire_ms)
    return rows.groupBy(*keys).transformWithStateInPandas(processor, output, "Update", mode)


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER_SETTING, None)
    spark.conf.set(PROVIDER_SETTING, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER_SETTING)
        else:
            spark.conf.set(PROVIDER_SETTING, before)


def start_running_state(states: DataFrame, path: str, checkpoint: str, **run) -> BatchRun:
    """Write what ``running_state`` emits, below ``batch_id=k``."""

    def handle(batch: DataFrame, batch_id: int) -> bool:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        return True

    with rocksdb(states.sparkSession):
        return BatchRun(states, handle, checkpoint, output_mode="update", **run)


def sum_and_max(state: tuple | None, rows: pd.DataFrame) -> tuple:
    """An update that keeps number, sum and maximum of the column ``value``; nulls are counted only."""
    n, total, most = state or (0, 0, None)
    values = rows["value"].dropna()
    if len(values):
        most = int(values.max()) if most is None else max(most, int(values.max()))
    return n + len(rows), total + int(values.sum()), most
