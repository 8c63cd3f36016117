"""Linear scores over sparse term counts.

Two-class naive Bayes, the linear classifier and two-centre k-means all decide
by the sign of one linear function, so each is a weight per slot, the bias at
the last one. Scoring a row is one pass over its non-zero counts, in the JVM and
without a shuffle.

A weight vector has ``width + 1`` numbers whatever the data size, so it is held
on the driver and goes into the plan as one literal.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vector_literal(values: np.ndarray) -> Column:
    """The vector as a constant; parsed once, when the plan is optimized."""
    numbers = [x if math.isfinite(x) else ("Infinity" if x > 0 else "-Infinity") for x in values.tolist()]
    return F.from_json(F.lit(json.dumps(numbers)), "array<double>")


def sparse_dot(weights: np.ndarray) -> Column:
    """Dot product of the row's ``terms`` with ``weights``."""
    vector = vector_literal(weights)
    return F.aggregate(
        "terms",
        F.lit(0.0),
        lambda total, term: total + term["count"] * F.get(vector, term["slot"]),
    )


def decide(margin: str | Column) -> Column:
    """Class 1 for a positive margin, else class 0 (ties included)."""
    margin = F.col(margin) if isinstance(margin, str) else margin
    return (margin > 0).cast("double")


def with_prediction(df: DataFrame, weights: np.ndarray, margin: str, prediction: str = "prediction") -> DataFrame:
    """Add the linear score and the class it decides."""
    return df.withColumn(margin, sparse_dot(weights)).withColumn(prediction, decide(margin))
