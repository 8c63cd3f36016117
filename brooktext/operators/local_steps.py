"""Local solvers: every task takes steps over its own rows, then the states are averaged.

One job a batch, whatever the number of steps. A task goes over its rows in
stretches (Arrow batches); each stretch is passed ``PASSES`` times in steps of
``ROWS_PER_STEP`` rows, one step after the other, on the task's own copy of the
state. The copies are averaged, weighted by their rows, in a tree: tasks send
their states to about the square root of as many, and only those sums reach
the driver. A batch in one partition is plain sequential training.

A stretch is held as the slots and counts that are not zero. The linear classifier
touches only the slots of a step: the shrinking of all other weights is one
factor kept beside them. The perceptron's moments move in every step, so its
cost follows the width.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from brooktext.functions.features import counts, slots
from brooktext.operators import linear_sgd, perceptron
from brooktext.operators.sums import State

ROWS_PER_STEP = 16
PASSES = 3
STATES = "model string, name string, vector array<double>, rows long"
STATE_SCHEMA = pa.schema([("model", pa.string()), ("name", pa.string()), ("vector", pa.list_(pa.float64())), ("rows", pa.int64())])


@dataclass
class Stretch:
    """Rows as non-zero slots with counts divided by the row's length; row ``i`` has ``starts[i]:starts[i + 1]``."""

    slots: np.ndarray
    values: np.ndarray
    starts: np.ndarray
    labels: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Stretch:
        slots = batch.column("slots")
        lengths = slots.value_lengths().to_numpy()
        starts = np.concatenate(([0], np.cumsum(lengths)))
        counts = batch.column("counts").flatten().to_numpy().astype(np.float64)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        norms = np.sqrt(np.bincount(owner, counts**2, minlength=len(lengths)))
        return cls(slots.flatten().to_numpy(), counts / np.maximum(norms, 1.0)[owner], starts, batch.column("label").to_numpy())

    def steps(self, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Slots, values, row (of the step) and labels of each step."""
        for first in range(0, len(self.labels), size):
            last = min(first + size, len(self.labels))
            a, b = self.starts[first], self.starts[last]
            owner = np.repeat(np.arange(last - first), np.diff(self.starts[first : last + 1]))
            yield self.slots[a:b], self.values[a:b], owner, self.labels[first:last]


def _chance(margin: np.ndarray) -> np.ndarray:
    small = np.exp(-np.abs(margin))
    return np.where(margin >= 0, 1 / (1 + small), small / (1 + small))


def residuals(margin: np.ndarray, label: np.ndarray, loss: str) -> np.ndarray:
    """Derivative of the loss in the margin, as ``linear_sgd.residual``."""
    if loss == "log":
        return _chance(margin) - label
    sign = 2 * label - 1
    return np.where(sign * margin <= 1, -sign, 0.0)


def sgd_steps(state: State | None, rows: Stretch, width: int, loss: str, size: int) -> State:
    """Steps of the linear classifier over a stretch; the state says that its rows are scaled."""
    if state is None:
        state = {"weight": np.zeros(width + 1), "step": np.zeros(1), "scaled": np.ones(1)}
    raw, bias, factor = state["weight"][:-1].copy(), float(state["weight"][-1]), 1.0
    step, offset = float(state["step"][-1]), linear_sgd.step_offset()
    for slots, values, owner, labels in rows.steps(size):
        margin = factor * np.bincount(owner, raw[slots] * values, minlength=len(labels)) + bias
        slope = residuals(margin, labels, loss) / len(labels)
        rate = 1.0 / (linear_sgd.ALPHA * (offset + step))
        factor *= 1.0 - rate * linear_sgd.ALPHA
        np.subtract.at(raw, slots, rate / factor * slope[owner] * values)
        bias -= rate * float(slope.sum())
        step += 1
        if factor < 1e-6:
            raw, factor = raw * factor, 1.0
    return {"weight": np.append(raw * factor, bias), "step": np.array([step]), "scaled": np.ones(1)}


def mlp_steps(state: State | None, rows: Stretch, width: int, size: int) -> State:
    """Adam steps of the perceptron over a stretch."""
    state = perceptron.mlp_state(state, width)
    units, top = perceptron.HIDDEN
    names = [f"unit{k}" for k in range(units)]
    vectors = {p: [np.stack([state[f"{p}{n}"] for n in names], axis=1), state[f"{p}deep"].copy()] for p in ("", "m_", "v_")}
    (first, deep), step = vectors[""], float(state["step"][0])
    penalised = np.ones(len(deep))
    penalised[units * top : units * top + top] = penalised[-1] = 0.0
    for slots, values, owner, labels in rows.steps(size):
        n = len(labels)
        second, second_bias, out, out_bias = perceptron.upper(deep)
        x = np.zeros((n, width + 1))
        x[owner, slots] = values
        x[:, -1] = 1.0
        h = np.maximum(x @ first, 0.0)
        z = np.maximum(h @ second + second_bias, 0.0)
        delta = _chance(z @ out + out_bias) - labels
        t = np.outer(delta, out) * (z > 0)
        u = (t @ second.T) * (h > 0)
        slope = x.T @ u / n
        slope[:-1] += perceptron.ALPHA / n * first[:-1]
        deep_slope = np.concatenate([(h.T @ t).ravel(), t.sum(axis=0), z.T @ delta, [delta.sum()]]) / n
        deep_slope += perceptron.ALPHA / n * penalised * deep
        step += 1
        rate = perceptron.RATE * math.sqrt(1 - perceptron.BETA2**step) / (1 - perceptron.BETA1**step)
        for k, gradient in enumerate((slope, deep_slope)):
            value, mean, square = (vectors[p][k] for p in ("", "m_", "v_"))
            mean += (1 - perceptron.BETA1) * (gradient - mean)
            square += (1 - perceptron.BETA2) * (gradient**2 - square)
            value -= rate * mean / (np.sqrt(square) + perceptron.EPSILON)
    new = {f"{p}{name}": vectors[p][0][:, k] for p in vectors for k, name in enumerate(names)}
    return new | {f"{p}deep": vectors[p][1] for p in vectors} | {"step": np.array([step])}


def _sent(cells: list[tuple[str, str, np.ndarray, int]]) -> pa.RecordBatch:
    columns = [
        pa.array([vector.tolist() for vector in values] if field.name == "vector" else values, field.type)
        for values, field in zip(zip(*cells, strict=True), STATE_SCHEMA, strict=True)
    ]
    return pa.RecordBatch.from_arrays(columns, schema=STATE_SCHEMA)


def _add(total: dict, rows: list[dict], weighted: bool) -> None:
    """Add states to a sum; ``step`` counts the steps of the task that took most."""
    for row in rows:
        key = (row["model"], row["name"])
        vector = np.array(row["vector"]) * (row["rows"] if weighted and row["name"] != "step" else 1)
        held, n = total.get(key, (None, 0))
        if held is None:
            total[key] = (vector, row["rows"])
        else:
            total[key] = (np.maximum(held, vector) if row["name"] == "step" else held + vector, n + row["rows"])


def local_updates(
    rows: DataFrame, prior: dict[str, State], models: tuple[str, ...], width: int, loss: str,
    passes: int = PASSES, size: int = ROWS_PER_STEP,
) -> dict[str, State]:
    """The states of ``models`` (``SGD``, ``MLP``) after the tasks' own steps; the prior ones without rows.

    ``rows`` needs ``label`` and ``features``. A task steps over its rows in the
    order in which it reads them.
    """
    if not models:
        return {}
    spark = rows.sparkSession
    kept = {name: prior[name] for name in models if name in prior}
    narrow = rows.select("label", slots().alias("slots"), counts().alias("counts"))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[str, State] = dict(kept)
        seen = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            stretch = Stretch.of(batch)
            seen += batch.num_rows
            for _ in range(passes):
                if "SGD" in models:
                    states["SGD"] = sgd_steps(states.get("SGD"), stretch, width, loss, size)
                if "MLP" in models:
                    states["MLP"] = mlp_steps(states.get("MLP"), stretch, width, size)
        if seen:
            yield _sent([(model, name, vector, seen) for model, state in states.items() for name, vector in state.items()])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            _add(total, batch.to_pylist(), weighted=True)
        if total:
            yield _sent([(*key, vector, n) for key, (vector, n) in total.items()])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    few = max(1, math.isqrt(tasks))
    sums = narrow.mapInArrow(solve, STATES).repartition(few).mapInArrow(added, STATES)
    total: dict = {}
    _add(total, [row.asDict() for row in sums.collect()], weighted=False)
    states = dict(kept)
    for model in models:
        vectors = {name: (v if name == "step" else v / n) for (m, name), (v, n) in total.items() if m == model}
        if vectors:
            states[model] = vectors
    return states
