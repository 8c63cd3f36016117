"""The one aggregation all incremental models share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Model state: named vectors of width + 1 numbers, the bias slot last.
State = dict[str, np.ndarray]


def slot_sums(rows: DataFrame, coefficients: dict[str, Column]) -> DataFrame:
    """Per slot, the sum over rows of ``coefficient * count``.

    A coefficient is a number per row: a class or cluster indicator for sums per
    group, a residual for a gradient. Several models thus share one pass over
    the rows. Map-side combining leaves at most ``width + 1`` rows per task for
    the shuffle, so neither the data size nor a class holding nearly all rows
    matters to it. The bias slot sums the coefficients themselves.
    """
    # The coefficients are fixed as columns before the rows are unfolded.
    prepared = rows.select(
        "terms", *[expression.cast("double").alias(name) for name, expression in coefficients.items()]
    )
    # Terms are never empty. A plain inline would make the optimizer test that,
    # hashing every text once more just for the test.
    terms = prepared.select(*coefficients, F.inline_outer("terms"))
    return terms.groupBy("slot").agg(*[F.sum(F.col(name) * F.col("count")).alias(name) for name in coefficients])


def fetch_sums(sums: DataFrame, width: int) -> State:
    """Slot sums as dense vectors; at most ``width + 1`` rows are fetched."""
    names = [name for name in sums.columns if name != "slot"]
    state = {name: np.zeros(width + 1) for name in names}
    for row in sums.collect():
        for name in names:
            state[name][row["slot"]] = row[name]
    return state
