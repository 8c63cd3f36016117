"""Multilayer perceptron: two hidden layers, ReLU, Adam. Its start and its scores.

It is trained by ``local_steps``. State, including Adam's moments, has the size
of the model and stays on the driver.

Counts of a row are divided by their length, so long texts do not saturate the
units. Only the hidden biases and the upper layers start positive: with all
weights of either sign, a net this small often starts with every unit off and
then never learns.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooktext.functions.linear import sparse_dot
from brooktext.operators.sums import State

# Layer sizes, penalty, seed and Adam's decay rates.
HIDDEN = (5, 2)
ALPHA = 1e-5
SEED = 42
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8
# The step size; larger than the usual 0.001, as a task takes few steps on a batch.
RATE = 0.05

UNITS, TOP = HIDDEN
# Places in the vector ``deep``: weights of layer 2 by (unit, top unit), its biases, the output weights, its bias.
DEEP = UNITS * TOP + TOP + TOP + 1


def _start(width: int) -> State:
    random = np.random.default_rng(SEED)
    state = {f"unit{k}": np.append(random.uniform(-1, 1, width), 0.1) for k in range(UNITS)}
    signs = np.resize([1.0, -1.0], TOP)
    state["deep"] = np.concatenate([random.uniform(0, 1, UNITS * TOP), np.full(TOP, 0.1), signs, [0.0]])
    for name in list(state):
        state |= {f"m_{name}": np.zeros_like(state[name]), f"v_{name}": np.zeros_like(state[name])}
    return state | {"step": np.zeros(1)}


def mlp_state(state: State | None, width: int) -> State:
    return _start(width) if state is None else state


def upper(deep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Weights and biases of layer 2, the output weights and its bias."""
    second = deep[: UNITS * TOP].reshape(UNITS, TOP)
    return second, deep[UNITS * TOP : UNITS * TOP + TOP], deep[UNITS * TOP + TOP : -1], float(deep[-1])


def with_layers(rows: DataFrame, state: State) -> DataFrame:
    """Add ``mlp_h*``, ``mlp_z*`` and the output ``mlp_margin``; ``rows`` needs ``terms`` and ``row_norm``."""
    second, second_bias, out, out_bias = upper(state["deep"])
    first = {}
    for k in range(UNITS):
        weights = state[f"unit{k}"].copy()
        bias, weights[-1] = float(weights[-1]), 0.0
        first[f"mlp_h{k}"] = F.greatest(sparse_dot(weights) / F.col("row_norm") + bias, F.lit(0.0))
    rows = rows.withColumns(first)
    top = {}
    for j in range(TOP):
        total = sum((F.col(f"mlp_h{k}") * float(second[k, j]) for k in range(UNITS)), F.lit(float(second_bias[j])))
        top[f"mlp_z{j}"] = F.greatest(total, F.lit(0.0))
    margin = sum((F.col(f"mlp_z{j}") * float(out[j]) for j in range(TOP)), F.lit(out_bias))
    return rows.withColumns(top).withColumn("mlp_margin", margin)
