"""Linear-chain conditional random fields over hashed token features.

Learning is full-batch gradient ascent: every step is one Spark pass over a
bounded sample of texts, whose tasks return the gradient (model-sized), and
the driver moves the weights by AdaGrad. Applying a model is one narrow pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooktext.llm.arrays import Texts, slices
from brooktext.llm.chains import messages
from brooktext.sources.workspace import materialize

STEPS = 10
RATE = 0.5
PENALTY = 1e-3


@dataclass
class Features:
    """Features of the tokens of some texts.

    Tokens of equal features share a type: token ``i`` is of type
    ``types[i]``, whose features are ``ids[borders[t]:borders[t + 1]]``, each
    counting ``values``. Tokens ``offsets[j]:offsets[j + 1]`` are text ``j``.
    """

    ids: np.ndarray
    values: np.ndarray
    borders: np.ndarray
    types: np.ndarray
    offsets: np.ndarray

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        if not len(self.types):
            return np.zeros((0, weights.shape[1]))
        scored = weights[self.ids] * self.values[:, None]
        return np.add.reduceat(scored, self.borders[:-1], axis=0)[self.types]

    def gradient(self, residuals: np.ndarray, size: int) -> np.ndarray:
        """Sum over tokens of features times residuals, as ``[feature, state]``."""
        kinds = len(self.borders) - 1
        per_type = [np.bincount(self.types, weights=column, minlength=kinds) for column in residuals.T]
        repeat = np.diff(self.borders)
        return np.stack(
            [np.bincount(self.ids, weights=np.repeat(c, repeat) * self.values, minlength=size) for c in per_type], axis=1
        )


@dataclass
class SlotFeatures:
    """The same number of features for every token: ``ids[token, slot]``."""

    ids: np.ndarray
    offsets: np.ndarray

    @property
    def types(self) -> np.ndarray:
        return np.arange(len(self.ids))

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        total = np.zeros((len(self.ids), weights.shape[1]))
        for slot in self.ids.T:
            total += weights[slot]
        return total

    def gradient(self, residuals: np.ndarray, size: int) -> np.ndarray:
        slots = self.ids.shape[1]
        columns = [np.bincount(self.ids.ravel(), weights=np.repeat(c, slots), minlength=size) for c in residuals.T]
        return np.stack(columns, axis=1)


@dataclass
class Model:
    """Weights of features and of transitions between states."""

    weights: np.ndarray
    transitions: np.ndarray
    initial: np.ndarray

    @staticmethod
    def empty(size: int, states: int) -> Model:
        return Model(np.zeros((size, states)), np.zeros((states, states)), np.zeros(states))


# The features of a slice of texts, and the state of each token given the labels of its rows.
Featurize = Callable[[Texts], Features | SlotFeatures]
Label = Callable[[Texts, Features | SlotFeatures, list], np.ndarray]


def bounded_sample(rows: DataFrame, key: str, size: int, group: str | None = None) -> DataFrame:
    """About ``size`` rows of each value of ``group`` (or of all rows), chosen by a hash of ``key``.

    Nothing is sorted, a rerun takes the same rows, and only keys and groups
    are shuffled: the keys drawn are few (``size`` a group), so they are
    broadcast to the rows.
    """
    share = F.pmod(F.xxhash64(key), F.lit(1 << 30)) / F.lit(1 << 30)
    narrow = rows.select(F.col(key).alias("sample_key"), *([F.col(group).alias("sample_group")] if group else []))
    hashed = narrow.withColumn("share", F.pmod(F.xxhash64("sample_key"), F.lit(1 << 30)) / F.lit(1 << 30))
    if group is None:
        return rows.where(share < size / max(rows.count(), 1))
    counts = narrow.groupBy(F.col("sample_group").alias("counted")).agg(F.count("*").alias("n"))
    drawn = hashed.join(counts, F.col("sample_group") == F.col("counted")).where(F.col("share") < F.lit(float(size)) / F.col("n"))
    drawn = materialize(drawn.select("sample_key").distinct(), "sample_keys")
    return rows.join(F.broadcast(drawn), F.col(key) == F.col("sample_key"), "left_semi")


def train(
    sample: DataFrame, featurize: Featurize, label: Label, size: int, states: int, steps: int = STEPS, joined: bool = False
) -> Model:
    """Fit a model to ``sample``: ``text`` and ``label`` (any type that ``label()`` understands).

    ``joined``: the texts of a slice form one chain, so that transitions
    between texts of different labels are seen too. An empty sample leaves
    the weights at zero.
    """
    spark = sample.sparkSession
    model = Model.empty(size, states)
    squares = [np.full(part.shape, 1e-8) for part in (model.weights, model.transitions, model.initial)]
    for _ in range(steps):
        shared = spark.sparkContext.broadcast(model)

        def gradient(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            now, tokens = shared.value, 0
            total = np.zeros((size, states))
            moves, first = np.zeros((states, states)), np.zeros(states)
            for batch in batches:
                labels = batch.column("label").to_pylist()
                for texts in slices(batch.column("text")):
                    features = featurize(texts)
                    if not len(features.types):
                        continue
                    truth = label(texts, features, labels)
                    offsets = np.array([0, len(truth)]) if joined else features.offsets
                    sent = messages(features.emissions(now.weights), offsets, now.transitions, now.initial)
                    posterior = sent.marginals()
                    total += features.gradient(np.eye(states)[truth] - posterior, size)
                    moves -= sent.pair_counts(offsets)
                    inner = np.ones(max(len(truth) - 1, 0), dtype=bool)
                    inner[offsets[(offsets > 0) & (offsets < len(truth))] - 1] = False
                    np.add.at(moves, (truth[:-1][inner], truth[1:][inner]), 1)
                    begin = offsets[:-1][np.diff(offsets) > 0]
                    np.add.at(first, truth[begin], 1)
                    first -= posterior[begin].sum(axis=0)
                    tokens += len(truth)
            packed = np.concatenate([[tokens], first, moves.ravel(), total.ravel()]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([packed.tobytes()], pa.binary())], ["sums"])

        parts = sample.select("text", "label").mapInArrow(gradient, "sums binary").collect()
        summed = sum(np.frombuffer(row["sums"]) for row in parts)
        if not parts or not summed[0]:
            return model
        first, moves, total = np.split(summed[1:] / summed[0], [states, states + states * states])
        now = (model.weights, model.transitions, model.initial)
        moved = []
        for weights, slope, square in zip(now, (total, moves, first), squares, strict=True):
            slope = slope.reshape(weights.shape) - PENALTY * weights / summed[0] ** 0.5
            square += slope**2
            moved.append(weights + RATE * slope / np.sqrt(square))
        model = Model(*moved)
        shared.unpersist()
    return model
