"""Multinomial naive Bayes from additive counts.

State: term counts ``n0, n1`` of the two classes; the bias slot holds the class
sizes. Batches add up, so the model does not depend on how the rows were cut
into batches.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from brooktext.operators.sums import State

# Fixed value: additive smoothing.
ALPHA = 0.0001


def nb_coefficients() -> dict[str, Column]:
    return {"n0": F.col("label") == 0, "n1": F.col("label") == 1}


def nb_update(state: State | None, sums: State) -> State:
    """Add the sums of one batch to the state."""
    if state is None:
        return {"n0": sums["n0"], "n1": sums["n1"]}
    return {name: state[name] + sums[name] for name in ("n0", "n1")}


def nb_log_likelihood(terms: np.ndarray, alpha: float = ALPHA) -> np.ndarray:
    return np.log(terms + alpha) - np.log(terms.sum() + alpha * len(terms))


def nb_weights(state: State, alpha: float = ALPHA) -> np.ndarray:
    """Log odds of class 1: likelihood ratios per slot, prior ratio as bias.

    Terms are smoothed, priors are not: a class without rows has no chance.
    """
    likelihood = nb_log_likelihood(state["n1"][:-1], alpha) - nb_log_likelihood(state["n0"][:-1], alpha)
    with np.errstate(divide="ignore"):
        prior = np.log(state["n1"][-1]) - np.log(state["n0"][-1])
    return np.append(likelihood, prior)
