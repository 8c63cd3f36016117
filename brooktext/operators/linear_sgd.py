"""Linear classifier by stochastic gradient descent, a micro-batch at a time.

Here a batch is one step over all its rows: margins and residuals per row, and
the gradient as one sum per slot. The training stream takes many steps instead,
each task over its own rows (``local_steps``), and divides a row's counts by their
length: with raw counts the first step sizes throw the weights far off.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from brooktext.functions.linear import sparse_dot
from brooktext.operators.sums import State

# Fixed value: L2 penalty.
ALPHA = 0.0001
LOSSES = ("log", "hinge")


def step_offset(alpha: float = ALPHA) -> float:
    """``t0`` of the decreasing step size ``1 / (alpha * (t0 + t))``.

    Chosen so the first step is as large as a typical weight.
    """
    typical_weight = math.sqrt(1.0 / math.sqrt(alpha))
    return 1.0 / (typical_weight * alpha)


def residual(margin: Column, loss: str) -> Column:
    """Derivative of the loss in the margin, per row."""
    if loss == "log":
        # exp of a non-positive number only, so large margins do not overflow
        small = F.exp(-F.abs(margin))
        chance = F.when(margin >= 0, 1 / (1 + small)).otherwise(small / (1 + small))
        return chance - F.col("label")
    if loss == "hinge":
        sign = 2 * F.col("label") - 1
        return F.when(sign * margin <= 1, -sign).otherwise(F.lit(0.0))
    raise ValueError(f"loss must be one of {LOSSES}")


def loss_value(margin: Column, loss: str) -> Column:
    signed = (2 * F.col("label") - 1) * margin
    if loss == "log":
        return F.log1p(F.exp(-F.abs(signed))) + F.greatest(-signed, F.lit(0.0))
    return F.greatest(1 - signed, F.lit(0.0))


def sgd_margin(state: State | None) -> Column:
    """Margin at the state's weights; all weights are zero without a state."""
    return F.lit(0.0) if state is None else sparse_dot(state["weight"])


def scaled_margin(state: State | None) -> Column:
    """Margin on counts divided by ``row_norm``."""
    if state is None:
        return F.lit(0.0)
    weights = state["weight"].copy()
    bias, weights[-1] = float(weights[-1]), 0.0
    return sparse_dot(weights) / F.col("row_norm") + bias


def sgd_coefficients(loss: str, margin: str = "sgd_margin") -> dict[str, Column]:
    """Residual of each row, from its margin column, and a row indicator."""
    return {"residual": residual(F.col(margin), loss), "rows": F.lit(1.0)}


def sgd_update(state: State | None, sums: State, alpha: float = ALPHA) -> State:
    """One step along the mean gradient; the bias is not shrunk."""
    if state is None:
        state = {"weight": np.zeros_like(sums["residual"]), "step": np.zeros_like(sums["residual"])}
    rate = 1.0 / (alpha * (step_offset(alpha) + state["step"][-1]))
    shrink = np.full_like(state["weight"], 1.0 - rate * alpha)
    shrink[-1] = 1.0
    weight = state["weight"] * shrink - rate * sums["residual"] / sums["rows"][-1]
    return {"weight": weight, "step": state["step"] + 1}


def sgd_weights(state: State) -> np.ndarray:
    return state["weight"]
