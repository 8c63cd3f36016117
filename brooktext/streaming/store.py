"""Models, labels and metrics as tables versioned by batch.

Everything of batch ``k`` goes below ``batch_id=k`` and is overwritten when the
batch is replayed. The metrics of a batch are written last and mark it as
complete; only complete batches before ``k`` are read for batch ``k``. So a
replay after a failure gives the same tables as an undisturbed run.

A long run leaves a small file for each batch. ``compact`` gathers those of
finished batches into one table and moves a pointer file to it; readers take the
table that the pointer names and the batches it does not have.
"""

from __future__ import annotations

import datetime
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from brooktext.operators.sums import State
from brooktext.sources.workspace import child_names, delete, exists, read_text, write_text

STATE_SCHEMA = "model string, name string, vector array<double>"
LABEL_SCHEMA = "label string, position bigint"
SETTINGS_SCHEMA = "width bigint"
METRIC_SCHEMA = (
    "model string, n bigint, tn bigint, fp bigint, fn bigint, tp bigint, accuracy double, precision double,"
    " recall double, aligned_accuracy double, batch_time timestamp, fitted boolean, batch_id bigint"
)
METRIC_TABLE = pa.schema(
    [
        ("model", pa.string()),
        *[(name, pa.int64()) for name in ("n", "tn", "fp", "fn", "tp")],
        *[(name, pa.float64()) for name in ("accuracy", "precision", "recall", "aligned_accuracy")],
        ("batch_time", pa.timestamp("us", tz="UTC")),
        ("fitted", pa.bool_()),
    ]
)
DEAD_SCHEMA = "record string, reject string, batch_id bigint"


class WidthMismatch(ValueError):
    """The stored models have another feature width than asked for."""


class ModelStore:
    def __init__(self, spark: SparkSession, root: str, width: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.width = self._settle_width(width)
        # The last version read or written, so that a running trainer need not re-read it.
        self._states: dict[int, dict[str, State]] = {}
        self._labels: dict[int, list[str]] = {}
        # Versions written by this store: of the open batch, and the last complete ones.
        self._open: dict[tuple[str, ...], int] = {}
        self._complete: dict[tuple[str, ...], int] = {}

    def _settle_width(self, width: int | None) -> int:
        path = f"{self.root}/settings"
        if exists(self.spark, f"{path}/_SUCCESS"):
            stored = self.spark.read.schema(SETTINGS_SCHEMA).parquet(path).first().width
            if width is not None and width != stored:
                raise WidthMismatch(f"models at {self.root} have width {stored}, not {width}")
            return stored
        if width is None:
            raise FileNotFoundError(f"no models at {self.root}")
        self._write(pa.table({"width": [width]}), "settings")
        return width

    def _write(self, table: pa.Table, *path: str) -> None:
        """Write a table of model size, as one file."""
        rows = self.spark.createDataFrame(table)
        rows.coalesce(1).write.mode("overwrite").parquet("/".join([self.root, *path]))

    def _batches(self, *path: str) -> list[int]:
        names = child_names(self.spark, "/".join([self.root, *path]))
        return sorted(int(name.split("=")[1]) for name in names if name.startswith("batch_id="))

    def latest(self, before: int | None, *path: str) -> int | None:
        """The last version of a table whose batch is complete, before ``before``.

        A running trainer knows it; folders are listed after a restart only.
        """
        known = self._complete.get(path)
        if known is not None and before is not None and known < before:
            return known
        for version in reversed(self._batches(*path)):
            if before is not None and version >= before:
                continue
            if self._is_complete(version):
                return version
        return None

    def save_states(self, batch_id: int, states: dict[str, State]) -> None:
        rows = [
            {"model": model, "name": name, "vector": vector.tolist()}
            for model, state in states.items()
            for name, vector in state.items()
        ]
        self._write(pa.Table.from_pylist(rows), "state", f"batch_id={batch_id}")
        self._open["state",] = batch_id
        self._states = {batch_id: states}

    def load_states(self, before: int | None = None) -> dict[str, State]:
        """States of the models by name; the rows fetched are model-sized."""
        version = self.latest(before, "state")
        if version is None:
            return {}
        if version not in self._states:
            states: dict[str, State] = {}
            table = self.spark.read.schema(STATE_SCHEMA).parquet(f"{self.root}/state/batch_id={version}")
            for row in table.collect():
                states.setdefault(row.model, {})[row["name"]] = np.array(row.vector)
            self._states = {version: states}
        return self._states[version]

    def save_labels(self, batch_id: int, labels: list[str]) -> None:
        table = pa.table({"label": pa.array(labels, pa.string()), "position": pa.array(range(len(labels)), pa.int64())})
        self._write(table, "labels", f"batch_id={batch_id}")
        self._open["labels",] = batch_id
        self._labels = {batch_id: labels}

    def load_labels(self, before: int | None = None) -> list[str]:
        version = self.latest(before, "labels")
        if version is None:
            return []
        if version not in self._labels:
            table = self.spark.read.schema(LABEL_SCHEMA).parquet(f"{self.root}/labels/batch_id={version}")
            rows = sorted(table.collect(), key=lambda row: row.position)
            self._labels = {version: [row.label for row in rows]}
        return self._labels[version]

    def save_metrics(self, batch_id: int, metrics: list[Row], fitted: list[str], table: str = "metrics") -> None:
        """Write one row per model; for the training table this completes the batch."""
        now = datetime.datetime.now(datetime.timezone.utc)
        rows = [{**row.asDict(), "batch_time": now, "fitted": row.model in fitted} for row in metrics]
        self._write(pa.Table.from_pylist(rows, METRIC_TABLE), table, f"batch_id={batch_id}")
        if table == "metrics":
            done = {path: k for path, k in self._open.items() if k == batch_id}
            self._complete |= {**done, ("metrics",): batch_id}
            self._open.clear()

    def prune(self, keep: int) -> None:
        """Delete model versions older than the ``keep`` newest complete ones.

        For long runs. Metrics, labels and dead letters are kept.
        """
        complete = [k for k in self._batches("state") if self._is_complete(k)]
        for version in complete[:-max(keep, 1)]:
            delete(self.spark, f"{self.root}/state/batch_id={version}")

    def _pointer(self, table: str) -> tuple[str, int] | None:
        """Folder of the compacted table and its last batch."""
        text = read_text(self.spark, f"{self.root}/{table}_compacted/pointer")
        if text is None:
            return None
        name, last = text.split()
        return f"{self.root}/{table}_compacted/{name}", int(last)

    def compact(self, table: str = "metrics", leave: int = 1) -> int | None:
        """Gather the finished batches of a table but the last ``leave``, which may be run again, into one.

        Returns the last batch gathered, None if there was nothing to do. A
        crash before the pointer moves leaves the old table in use, one after it
        leaves batch folders that the next call deletes; neither shows in a reader.
        """
        pointer = self._pointer(table)
        done = [k for k in self._batches(table) if exists(self.spark, f"{self.root}/{table}/batch_id={k}/_SUCCESS")]
        done = done[: len(done) - leave] if leave else done
        if not done:
            return None
        last = max([*done, pointer[1]] if pointer else done)
        held = self._read(METRIC_SCHEMA, table).where(F.col("batch_id") <= last)
        name = f"table-{last}-{uuid.uuid4().hex}"
        held.coalesce(1).write.parquet(f"{self.root}/{table}_compacted/{name}")
        write_text(self.spark, f"{self.root}/{table}_compacted/pointer", f"{name} {last}")
        for batch_id in done:
            delete(self.spark, f"{self.root}/{table}/batch_id={batch_id}")
        for old in child_names(self.spark, f"{self.root}/{table}_compacted"):
            if old.startswith("table-") and old != name:
                delete(self.spark, f"{self.root}/{table}_compacted/{old}")
        return last

    def _is_complete(self, batch_id: int) -> bool:
        pointer = self._pointer("metrics")
        # Batches are run in order: those up to the pointer are finished.
        if pointer and batch_id <= pointer[1]:
            return True
        return exists(self.spark, f"{self.root}/metrics/batch_id={batch_id}/_SUCCESS")

    def metrics(self, table: str = "metrics") -> DataFrame:
        return self._read(METRIC_SCHEMA, table)

    def save_dead_letters(self, batch_id: int, rows: DataFrame, table: str = "dead_letters") -> None:
        path = f"{self.root}/{table}/batch_id={batch_id}"
        rows.select("record", "reject").write.mode("overwrite").parquet(path)

    def dead_letters(self, table: str = "dead_letters") -> DataFrame:
        return self._read(DEAD_SCHEMA, table)

    def _read(self, schema: str, table: str) -> DataFrame:
        batches, pointer = self._batches(table), self._pointer(table)
        parts = []
        if batches:
            parts.append(self.spark.read.schema(schema).parquet(f"{self.root}/{table}"))
        if pointer:
            gathered = self.spark.read.schema(schema).parquet(pointer[0])
            # A batch that is here as a folder too was run again, or its folder was not deleted yet.
            again = [k for k in batches if k <= pointer[1]]
            parts.append(gathered.where(~F.col("batch_id").isin(again)) if again else gathered)
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def state_table(self) -> DataFrame:
        """All stored versions of the models."""
        return self._read(f"{STATE_SCHEMA}, batch_id bigint", "state")
