"""Logistic regression by distributed Newton steps, and its cross-validation.

The objective is the summed log loss and half the squared weights; the bias is
not penalised. One job per step: every task turns its rows into small dense
blocks and adds up loss, gradient and Hessian, matrices of the feature width
whatever the data size; they are added in a tree and solved on the driver. A
step that does not lower the loss is halved. A fit starts at the weights of the batch
before and ends when the mean gradient is below ``TOLERANCE``.

Cross-validation fits all training sets at once. At the common start the sums
are kept per fold, and a training set's sums are the total less its fold's.
From then on the training sets have weights of their own, and one pass serves all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooktext.functions.features import counts, slots
from brooktext.operators.sums import State
from brooktext.operators.task_sums import task_sums

# Solver settings.
LR_MAX_ITER = 50
TOLERANCE = 1e-6
GRID_MAX_ITER = [10, 50]
PENALTY = 1.0
FOLDS = 5
# The Hessian has the square of the width; beyond this width the stepped learners are the choice.
MOST_WIDTH = 4096
# Rows of a dense block.
BLOCK = 1024
# A loss within this share of the last one is as low: it is summed with rounding.
ROUNDING = 1e-12
HALVINGS = 30


@dataclass
class Objective:
    """Loss, gradient and Hessian sums of some rows at some weights, without the penalty."""

    n: float
    loss: float
    gradient: np.ndarray
    hessian: np.ndarray

    def __sub__(self, other: Objective) -> Objective:
        return Objective(
            self.n - other.n, self.loss - other.loss, self.gradient - other.gradient, self.hessian - other.hessian
        )

    def at(self, weight: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Loss, gradient and Hessian with the penalty on all weights but the bias."""
        shrunk = PENALTY * weight
        shrunk[-1] = 0.0
        penalty = np.full(len(weight), PENALTY)
        penalty[-1] = 0.0
        return self.loss + 0.5 * float(shrunk @ weight), self.gradient + shrunk, self.hessian + np.diag(penalty)


def _narrow(rows: DataFrame, fold: Column | None = None) -> DataFrame:
    return rows.select("label", slots().alias("slots"), counts().alias("counts"), (F.lit(0) if fold is None else fold).cast("int").alias("fold"))


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Dense rows with a bias column, labels and folds, a block at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK):
            part = batch.slice(first, BLOCK)
            x = np.zeros((part.num_rows, width + 1))
            lists = part.column("slots")
            owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
            x[owner, lists.flatten().to_numpy()] = part.column("counts").flatten().to_numpy()
            x[:, -1] = 1.0
            yield x, part.column("label").to_numpy(), part.column("fold").to_numpy()


def _sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    margin = x @ weight
    small = np.exp(-np.abs(margin))
    chance = np.where(margin >= 0, 1 / (1 + small), small / (1 + small))
    signed = (2 * y - 1) * margin
    loss = float((np.log1p(small) + np.maximum(-signed, 0.0)).sum())
    curve = x * (chance * (1 - chance))[:, None]
    return [np.array([len(y), loss]), x.T @ (chance - y), x.T @ curve]


def objectives(narrow: DataFrame, width: int, weights: list[np.ndarray], by_fold: bool) -> list[Objective]:
    """One pass: with ``by_fold`` the sums of each fold at the one weight of the list; else of each
    weight ``k`` over the rows outside fold ``k``, or over all rows if there is but one weight."""
    many = len(weights) if not by_fold else FOLDS

    def local(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        totals: dict[int, list[np.ndarray]] = {}
        for x, y, fold in _blocks(batches, width):
            for k in range(many):
                if by_fold:
                    own, weight = fold == k, weights[0]
                else:
                    own, weight = (fold != k) | (many == 1), weights[k]
                if own.all():
                    part = _sums(x, y, weight)
                elif own.any():
                    part = _sums(x[own], y[own], weight)
                else:
                    continue
                totals[k] = [a + b for a, b in zip(totals[k], part, strict=True)] if k in totals else part
        return {f"{k}/{i}": v for k, parts in totals.items() for i, v in enumerate(parts)}

    sums = task_sums(narrow, local)
    d = width + 1
    out = []
    for k in range(many):
        head = sums.get(f"{k}/0", np.zeros(2))
        gradient, hessian = sums.get(f"{k}/1", np.zeros(d)), sums.get(f"{k}/2", np.zeros(d * d))
        out.append(Objective(head[0], head[1], gradient, hessian.reshape(d, d)))
    return out


@dataclass
class Fit:
    """One fit on its way: the weights at which the last sums were taken, and the step from there."""

    weight: np.ndarray
    loss: float = np.inf
    step: np.ndarray | None = None
    scale: float = 1.0
    iterations: int = 0
    norm: float = np.inf
    done: bool = False

    def trial(self) -> np.ndarray:
        return self.weight if self.step is None else self.weight + self.scale * self.step

    def take(self, sums: Objective, limit: int) -> None:
        """Go on from the sums at ``trial()``: accept it, or halve the step."""
        at = self.trial()
        loss, gradient, hessian = sums.at(at)
        if self.step is not None and not loss <= self.loss + ROUNDING * abs(self.loss):
            self.scale /= 2
            self.done = self.scale < 0.5**HALVINGS
            return
        if self.step is not None:
            self.iterations += 1
        self.weight, self.loss, self.norm = at, loss, float(np.linalg.norm(gradient)) / max(sums.n, 1.0)
        self.done = self.norm < TOLERANCE or self.iterations >= limit
        # A bias without curvature (all rows decided) would make the matrix singular.
        hessian[-1, -1] += 1e-12
        self.step, self.scale = -np.linalg.solve(hessian, gradient), 1.0


def lr_fit(rows: DataFrame, width: int, prior: State | None = None, limit: int = LR_MAX_ITER) -> State:
    """The fit on these rows: ``weight`` with the bias last, its mean ``gradient`` norm and its ``iterations``.

    Starts at ``prior``, which does not change the optimum. ``rows``: ``label`` and ``features``.
    """
    if width > MOST_WIDTH:
        raise ValueError(f"width {width}: the Hessian is kept for widths up to {MOST_WIDTH}")
    fit = Fit(np.zeros(width + 1) if prior is None else prior["weight"].copy())
    narrow = _narrow(rows)
    while not fit.done:
        fit.take(objectives(narrow, width, [fit.trial()], by_fold=False)[0], limit)
    return {"weight": fit.weight, "gradient": np.array([fit.norm]), "iterations": np.array([float(fit.iterations)])}


def lr_weights(state: State) -> np.ndarray:
    return state["weight"]


def fold_of(key: str = "row_id", folds: int = FOLDS) -> Column:
    return F.pmod(F.col(key), F.lit(folds)).cast("int")


def cross_fits(rows: DataFrame, width: int, limit: int, fold: Column, start: np.ndarray | None = None) -> list[Fit]:
    """A fit for each training set, all but one fold; ``start`` is where all of them begin."""
    narrow = _narrow(rows, fold)
    start = np.zeros(width + 1) if start is None else start
    held_out = objectives(narrow, width, [start], by_fold=True)
    total = Objective(
        *[sum(getattr(o, name) for o in held_out) for name in ("n", "loss", "gradient", "hessian")]
    )
    fits = [Fit(start.copy()) for _ in range(FOLDS)]
    for fit, own in zip(fits, held_out, strict=True):
        fit.take(total - own, limit)
    while not all(fit.done for fit in fits):
        for fit, sums in zip(fits, objectives(narrow, width, [fit.trial() for fit in fits], by_fold=False), strict=True):
            if not fit.done:
                fit.take(sums, limit)
    return fits


def fold_scores(rows: DataFrame, width: int, fits: list[Fit], fold: Column) -> list[float]:
    """r2 of the predicted class on each fold, by its training set's fit; folds without a spread are left out."""
    weights = [fit.weight for fit in fits]

    def local(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        totals = np.zeros((FOLDS, 3))
        for x, y, of in _blocks(batches, width):
            for k in np.unique(of):
                own = of == k
                wrong = ((x[own] @ weights[k]) > 0) != (y[own] > 0)
                totals[k] += own.sum(), y[own].sum(), wrong.sum()
        return {"totals": totals}

    totals = task_sums(_narrow(rows, fold), local).get("totals", np.zeros(3 * FOLDS)).reshape(FOLDS, 3)
    spread = [(n - ones) * ones / n if n else 0.0 for n, ones, _ in totals]
    return [1.0 - wrong / s for (_, _, wrong), s in zip(totals, spread, strict=True) if s > 0]


def lr_grid_search(rows: DataFrame, width: int, limits: list[int] = GRID_MAX_ITER) -> list[tuple[int, float]]:
    """Mean cross-validated r2 of ``lr_fit``'s model for each iteration limit, started at the fit on all rows."""
    start, fold, scores = lr_fit(rows, width)["weight"], fold_of(), []
    fits: list[Fit] = []
    for limit in sorted(limits):
        # Fits that ended before the last limit are the same under a higher one.
        if not fits or any(fit.norm >= TOLERANCE for fit in fits):
            fits = cross_fits(rows, width, limit, fold, start)
        found = fold_scores(rows, width, fits, fold)
        scores.append((limit, float(np.mean(found)) if found else 0.0))
    return scores
