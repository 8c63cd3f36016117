"""Two-centre k-means over micro-batches, as a count-weighted running mean.

State: sums ``s0, s1`` of the rows given to each centre (the bias slot counts
them) and the starting centres ``i0, i1``, which stand in while a centre has no
rows yet.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooktext.functions.linear import decide, sparse_dot
from brooktext.operators.sums import State


def _dense_row(terms: list, width: int) -> np.ndarray:
    vector = np.zeros(width + 1)
    for term in terms:
        vector[term["slot"]] = term["count"]
    vector[-1] = 0.0
    return vector


def kmeans_start(rows: DataFrame, width: int) -> State:
    """Starting centres: the row of lowest id, then the row farthest from it.

    Both are picked by partial aggregates, without sorting; one row each is
    fetched. Ties go to the lower id, so the choice does not depend on the
    partitioning.
    """
    first = _dense_row(rows.agg(F.min_by("terms", "row_id").alias("terms")).first()["terms"], width)
    square = F.aggregate("terms", F.lit(0.0), lambda total, term: total + term["count"] * term["count"])
    distance = square - 2 * sparse_dot(first)
    farthest = F.max_by(F.col("terms"), F.struct(distance, -F.col("row_id")))
    second = _dense_row(rows.agg(farthest.alias("terms")).first()["terms"], width)
    return {"s0": np.zeros(width + 1), "s1": np.zeros(width + 1), "i0": first, "i1": second}


def kmeans_centres(state: State) -> tuple[np.ndarray, np.ndarray]:
    """Mean of each centre's rows, or its start if it has none."""
    return tuple(
        state[f"s{j}"][:-1] / state[f"s{j}"][-1] if state[f"s{j}"][-1] > 0 else state[f"i{j}"][:-1] for j in (0, 1)
    )


def kmeans_weights(state: State) -> np.ndarray:
    """Squared distance to centre 0 minus that to centre 1, as linear weights."""
    c0, c1 = kmeans_centres(state)
    return np.append(2 * (c1 - c0), (c0 * c0).sum() - (c1 * c1).sum())


def kmeans_margin(state: State) -> Column:
    return sparse_dot(kmeans_weights(state))


def kmeans_coefficients(margin: str = "kmeans_margin") -> dict[str, Column]:
    """Membership of the nearer centre, from the margin column."""
    nearer = decide(margin)
    return {"s0": nearer == 0, "s1": nearer == 1}


def kmeans_update(state: State, sums: State) -> State:
    """Add the batch's sums per centre; the means follow from them."""
    return {**state, "s0": state["s0"] + sums["s0"], "s1": state["s1"] + sums["s1"]}
