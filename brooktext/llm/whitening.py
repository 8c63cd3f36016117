"""Whitening of embeddings by the covariance of their integer vectors.

Method, polarisation. For every dimension ``i`` the squares of the centred
values ``d = n * x - S`` are summed exactly, and for every pair of dimensions
the squares of ``d_i + d_j``. A covariance then is a difference of variances:
``(Q_ij - Q_i - Q_j) / 2``. No product of two dimensions is ever formed. The
integers are put together on the driver, divided once, and given to ``eigh``.

Scale. The fit list is the distinct vectors, combined in each task before the
shuffle, so a vector that a third of all rows hold is one row. Its sums take
two passes; a task returns ``width * (width + 1) / 2`` integers whatever it
has read, which Spark adds up as decimals. Only these sums, of the model's
size, reach the driver. Centring waits for ``S``, so the squares are a pass of
their own over the staged fit list.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooktext.llm.vectors import largest, matrix
from brooktext.sources.workspace import materialize

COMPONENTS = 4
# A component whose share of the variance is not above this has none: rounding of ``eigh`` alone.
LEAST_SHARE = 1e-12
# Rows whose squares are summed at once.
BLOCK = 2048
# Larger centred values are cut into parts of so many bits before they are squared.
PART_BITS = 21
MOST_LONG = (1 << 63) - 1

SUMS = "i int, j int, value decimal(38,0)"
RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


@dataclass
class Basis:
    """What a task needs to whiten rows: counts, sums and the leading components."""

    n: int
    sums: list[int]
    axes: np.ndarray  # one column for each component
    variances: np.ndarray
    explained: np.ndarray
    live: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Projections on the components over their deviations; 0 for a component without variance."""
        d = (self.centred(x) / self.n).astype(np.float64)
        scale = np.where(self.live, np.sqrt(np.where(self.live, self.variances, 1.0)), np.inf)
        return (d @ self.axes) / scale


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, in 64 bits where that holds it and as Python integers beyond."""
    if largest(x) * n + max([0, *map(abs, sums)]) <= MOST_LONG // 2:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def square_sums(values: np.ndarray) -> list[int]:
    """The exact sum of squares of every column."""
    most = largest(values)
    if values.dtype == object:
        return [int(total) for total in (values * values).sum(axis=0)]
    if most * most * len(values) <= MOST_LONG:
        return [int(total) for total in np.einsum("ij,ij->j", values, values)]
    parts, rest = [], values
    for _ in range(2):
        parts.append(rest & ((1 << PART_BITS) - 1))
        rest = rest >> PART_BITS
    parts.append(rest)
    total = [0] * values.shape[1]
    for a, left in enumerate(parts):
        for b, right in enumerate(parts):
            both = np.einsum("ij,ij->j", left, right)
            total = [t + (int(v) << (PART_BITS * (a + b))) for t, v in zip(total, both, strict=True)]
    return total


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        x = matrix(batch.column("x"))
        for first in range(0, len(x), BLOCK):
            yield x[first : first + BLOCK]


def _sum_rows(cells: dict[tuple[int, int], int]) -> pa.RecordBatch:
    keys = list(cells)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _ in keys], pa.int32()),
            pa.array([j for _, j in keys], pa.int32()),
            pa.array([Decimal(cells[key]) for key in keys], pa.decimal128(38, 0)),
        ],
        ["i", "j", "value"],
    )


def _added(sums: DataFrame) -> dict[tuple[int, int], int]:
    """The tasks' sums added up; as many rows as the model has numbers are fetched."""
    rows = sums.groupBy("i", "j").agg(F.sum("value").cast("decimal(38,0)").alias("value")).collect()
    return {(row.i, row.j): int(row.value) for row in rows}


def count_and_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and their sum in every dimension."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, totals = 0, {}
        for x in _blocks(batches):
            n += len(x)
            wide = x if largest(x) * len(x) <= MOST_LONG else x.astype(object)
            for i, total in enumerate(wide.sum(axis=0)):
                totals[i, 0] = totals.get((i, 0), 0) + int(total)
        if n:
            yield _sum_rows({(-1, 0): n, **totals})

    cells = _added(fit.mapInArrow(local, SUMS))
    return cells.pop((-1, 0), 0), [cells[key] for key in sorted(cells)]


def polarised_squares(fit: DataFrame, n: int, sums: list[int]) -> dict[tuple[int, int], int]:
    """``(i, i)``: squares of ``d_i`` summed; ``(i, j)``: those of ``d_i + d_j``, for ``i < j``."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[tuple[int, int], int] = {}

        def add(i: int, first: int, values: np.ndarray) -> None:
            for k, total in enumerate(square_sums(values)):
                key = (i if i >= 0 else k, first + k)
                cells[key] = cells.get(key, 0) + total

        for x in _blocks(batches):
            d = centred(x, n, sums)
            add(-1, 0, d)
            for i in range(d.shape[1] - 1):
                add(i, i + 1, d[:, i : i + 1] + d[:, i + 1 :])
        if cells:
            yield _sum_rows(cells)

    return _added(fit.mapInArrow(local, SUMS))


def covariance(squares: dict[tuple[int, int], int], n: int, width: int) -> np.ndarray:
    """Covariances with divisor ``n``, each rounded once from its exact integer."""
    out = np.zeros((width, width))
    for (i, j), value in squares.items():
        if i == j:
            out[i, i] = value / n**3
        else:
            out[i, j] = out[j, i] = (value - squares[i, i] - squares[j, j]) / (2 * n**3)
    return out


def fit_basis(fit: DataFrame, top: int = COMPONENTS) -> Basis | None:
    """The leading components of the fit list (``x``, each vector once); None without vectors."""
    n, sums = count_and_sums(fit)
    if n == 0:
        return None
    v = covariance(polarised_squares(fit, n, sums), n, len(sums))
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:top]
    trace = float(np.trace(v))
    variances = np.maximum(values[order], 0.0)
    explained = variances / trace if trace > 0 else np.zeros(len(order))
    return Basis(n, sums, vectors[:, order], variances, explained, explained > LEAST_SHARE)


def identity_error(fit: DataFrame, basis: Basis) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity, as measured."""
    top = len(basis.variances)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, means = np.zeros((top, top)), np.zeros(top)
        for x in _blocks(batches):
            w = basis.whiten(x)
            products += w.T @ w
            means += w.sum(axis=0)
        cells = [(i, j, products[i, j]) for i in range(top) for j in range(top)] + [(i, -1, means[i]) for i in range(top)]
        i, j, value = zip(*cells, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(value)], ["i", "j", "value"])

    sums = fit.mapInArrow(local, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    cells = {(row.i, row.j): row.value / basis.n for row in sums.collect()}
    live = [i for i in range(top) if basis.live[i]]
    return max((abs(cells[i, j] - cells[i, -1] * cells[j, -1] - (i == j)) for i in live for j in live), default=0.0)


def _deviations(d: np.ndarray) -> pa.Array:
    """Sum over dimensions of the squares; null where a long cannot hold it."""
    totals = square_sums(d.T)
    return pa.array([total if total <= MOST_LONG else None for total in totals], pa.int64())


def whiten_embeddings(rows: DataFrame, top: int = COMPONENTS) -> DataFrame:
    """``rows`` (``vec_id``, ``x``) projected on the leading components: a row for each of them.

    Returns ``vec_id, component, n, deviation, whitened, explained,
    identity_error``; ``n`` is the number of distinct vectors, ``deviation`` the
    exact sum of ``(n * x - S)^2`` (null where a long cannot hold it).
    ``x`` holds integers of one length (see ``vectors``), which is where nulls
    and non-finite entries go. Equal rows count once in the fit and come out
    each; a null ``vec_id`` is kept; vectors of fewer dimensions than ``top``
    have as many components as dimensions; a component without variance (one
    vector, or fewer independent ones than components) has ``whitened`` 0 and no
    part in ``identity_error``; other columns are not read; no rows give no rows.
    """
    rows = materialize(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x"), "vectors")
    fit = materialize(rows.select("x").distinct(), "fit_list")
    basis = fit_basis(fit, top)
    if basis is None:
        return rows.sparkSession.createDataFrame([], RESULT)
    error = identity_error(fit, basis)
    names = [field.strip().split(" ")[0] for field in RESULT.split(",")]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(basis.variances)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"))
            each = pa.array(np.repeat(np.arange(len(x)), k))
            columns = [
                batch.column("vec_id").take(each),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * k, basis.n)),
                _deviations(basis.centred(x)).take(each),
                pa.array(basis.whiten(x).ravel()),
                pa.array(np.tile(basis.explained, len(x))),
                pa.array(np.full(len(x) * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(project, RESULT)
