"""Integer vectors from embedding columns, and their NumPy form inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
# Sums of products below this are exact as doubles.
EXACT_DOUBLE = 1 << 53


def _usable(vector: Column) -> Column:
    """Not null, and every entry neither null nor non-finite."""

    def bad(entry: Column) -> Column:
        return entry.isNull() | F.isnan(entry) | (F.abs(entry) == float("inf"))

    return vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(False))


def integer_vectors(rows: DataFrame, column: str, *keep: Column | str, scale: int = SCALE) -> DataFrame:
    """``keep`` and ``x``, the vector as ``floor(scale * entry)``, of the rows whose vector is usable.

    Rows with a null vector or a null or non-finite entry are left out. Vectors
    of unlike length are filled up with zeros to the longest one.
    """
    vector = F.col(column).cast("array<double>")
    floored = F.transform(vector, lambda entry: F.floor(entry * scale).cast("long"))
    found = rows.where(_usable(vector)).select(*keep, floored.alias("x"))
    width = found.agg(F.max(F.size("x")).alias("width"), F.min(F.size("x")).alias("least")).first()
    if width["width"] != width["least"]:
        filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width["width"]) - F.size("x")))
        found = found.withColumn("x", filled)
    return found


def matrix(column: pa.Array) -> np.ndarray:
    """A column of integer vectors of one length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def largest(values: np.ndarray) -> int:
    """The largest magnitude, as an unbounded integer."""
    return max(int(values.max()), -int(values.min())) if values.size else 0


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of two integer matrices."""
    if largest(left) * largest(right) * max(left.shape[1], 1) < EXACT_DOUBLE:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left @ right.T
