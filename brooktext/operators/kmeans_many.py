"""K-means with any number of centres over micro-batches.

Start: k-means||. From one row on, a few rounds draw rows with chances in
proportion to their squared distance from the rows drawn so far, about
``OVERSAMPLE * k`` a round; each drawn row is weighted by the rows nearest to it,
and the centres are picked from these few by weighted k-means++. Draws depend on
a hash of the row id, so reruns agree.

Update: each batch adds its rows' sums and counts to those of their nearest
centre, one pass; a centre is the mean of all rows it was ever given. A centre
with fewer than ``STARVING`` of the rows of the largest one is starving: it moves
to the row of the batch that lies farthest from its own centre, and its sums
start anew. Sums are of model size whatever the data size (``task_sums``); drawn rows
and far rows are fetched, a few for each centre.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooktext.functions.features import counts, slots
from brooktext.operators.sums import State
from brooktext.operators.task_sums import task_sums

ROUNDS = 5
OVERSAMPLE = 2
PICKS = 16
# Fixed value: the share of the largest centre's rows below which a centre is reassigned.
STARVING = 0.01
SEED = 42
BLOCK = 1024
FAR = "distance double, row_id long, slots array<int>, counts array<double>"


def _narrow(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("row_id").cast("long").alias("row_id"), slots().alias("slots"), counts().alias("counts"))


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK):
            part = batch.slice(first, BLOCK)
            x = np.zeros((part.num_rows, width))
            lists = part.column("slots")
            owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
            x[owner, lists.flatten().to_numpy()] = part.column("counts").flatten().to_numpy()
            yield part, x


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (x**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None] - 2 * (x @ centres.T)
    return np.maximum(squares, 0.0)


def _dense(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, row["slots"]] = row["counts"]
    return out


def inertia(rows: DataFrame, centres: np.ndarray) -> float:
    """Summed squared distance of the rows from their nearest centres."""

    def local(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        return {"sum": np.array([sum(float(_distances(x, centres).min(axis=1).sum()) for _, x in _blocks(batches, centres.shape[1]))])}

    return float(task_sums(_narrow(rows), local).get("sum", np.zeros(1))[0])


def _drawn(rows: DataFrame, centres: np.ndarray, turn: int, chance: float) -> np.ndarray:
    """Rows drawn with chance ``chance * squared distance``."""
    width = centres.shape[1]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, width):
            odds = part.column("odds").to_numpy()
            yield part.filter(pa.array(odds < chance * _distances(x, centres).min(axis=1))).select(["slots", "counts"])

    odds = F.pmod(F.xxhash64("row_id", F.lit(SEED), F.lit(turn)), F.lit(1 << 53)) / float(1 << 53)
    found = _narrow(rows).withColumn("odds", odds).mapInArrow(local, "slots array<int>, counts array<double>")
    return _dense(found.distinct().orderBy("slots", "counts").collect(), width)


def _weighted_plus_plus(points: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """The best of a few picks among the drawn points, by their weighted cost."""
    random = np.random.default_rng(SEED)
    best, least = points[:1], np.inf
    for _ in range(PICKS):
        chosen = [int(weights.argmax())]
        cost = _distances(points, points[chosen]).min(axis=1) * weights
        while len(chosen) < min(k, len(points)) and cost.sum() > 0:
            chosen.append(int(random.choice(len(points), p=cost / cost.sum())))
            cost = _distances(points, points[chosen]).min(axis=1) * weights
        if cost.sum() < least:
            best, least = points[chosen], float(cost.sum())
    return best


def parallel_start(rows: DataFrame, width: int, k: int) -> np.ndarray:
    """At most ``k`` starting centres; fewer if there are fewer different rows, none without rows."""
    first = _narrow(rows).agg(F.min_by(F.struct("slots", "counts"), "row_id").alias("row")).first()["row"]
    if first is None:
        return np.zeros((0, width))
    points = _dense([first], width)
    for turn in range(ROUNDS):
        cost = inertia(rows, points)
        if cost <= 0:
            break
        points = np.vstack([points, _drawn(rows, points, turn, OVERSAMPLE * k / cost)])
    points = np.unique(points, axis=0)
    return _weighted_plus_plus(points, assigned(rows, points)["counts"], k)


def assigned(rows: DataFrame, centres: np.ndarray) -> State:
    """``sums`` (flat) and ``counts`` of the rows nearest to each centre; ties go to the earlier one."""
    k, width = centres.shape

    def local(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        sums, n = np.zeros((k, width)), np.zeros(k)
        for _, x in _blocks(batches, width):
            member = np.zeros((len(x), k))
            member[np.arange(len(x)), _distances(x, centres).argmin(axis=1)] = 1.0
            sums += member.T @ x
            n += member.sum(axis=0)
        return {"sums": sums, "counts": n}

    found = task_sums(_narrow(rows), local)
    return {"sums": found.get("sums", np.zeros(k * width)), "counts": found.get("counts", np.zeros(k))}


def _farthest(rows: DataFrame, centres: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` rows farthest from their centres, ties by id; a task sends ``n`` at most."""
    width = centres.shape[1]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: pa.Table | None = None
        for part, x in _blocks(batches, width):
            told = pa.table([pa.array(_distances(x, centres).min(axis=1)), *part.columns], ["distance", "row_id", "slots", "counts"])
            both = told if best is None else pa.concat_tables([best, told])
            best = both.take(np.lexsort((both["row_id"].to_numpy(), -both["distance"].to_numpy()))[:n])
        if best is not None:
            yield from best.combine_chunks().to_batches()

    top = _narrow(rows).mapInArrow(local, FAR).orderBy(F.desc("distance"), "row_id").limit(n).collect()
    return _dense(top, width)


def centres_of(state: State) -> np.ndarray:
    """The mean of each centre's rows, or its start if it has none."""
    sums, n = state["sums"].reshape(len(state["counts"]), -1), state["counts"]
    start = state["start"].reshape(sums.shape)
    return np.where(n[:, None] > 0, sums / np.maximum(n, 1.0)[:, None], start)


def many_update(state: State | None, rows: DataFrame, width: int, k: int, reassign: bool = True) -> State | None:
    """One batch: assign, add up, reassign starving centres. None as long as no row came."""
    if state is None:
        start = parallel_start(rows, width, k)
        if not len(start):
            return None
        state = {"start": start.ravel(), "sums": np.zeros(start.size), "counts": np.zeros(len(start))}
    centres = centres_of(state)
    batch = assigned(rows, centres)
    new = {"start": centres.ravel(), "sums": state["sums"] + batch["sums"], "counts": state["counts"] + batch["counts"]}
    starving = np.flatnonzero(new["counts"] < STARVING * new["counts"].max())
    if reassign and len(starving) and batch["counts"].sum() > 0:
        places = _farthest(rows, centres_of(new), len(starving))
        start, sums = new["start"].reshape(centres.shape).copy(), new["sums"].reshape(centres.shape).copy()
        for j, place in zip(starving, places, strict=False):
            start[j], sums[j], new["counts"][j] = place, 0.0, 0.0
        new |= {"start": start.ravel(), "sums": sums.ravel()}
    return new
