"""Confusion counts and the rates derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRIC_COLUMNS = ["model", "n", "tn", "fp", "fn", "tp", "accuracy", "precision", "recall", "aligned_accuracy"]


def _cells(prediction: str) -> Column:
    label, predicted = F.col("label"), F.col(prediction)
    return F.struct(
        F.count_if((label == 0) & (predicted == 0)).alias("tn"),
        F.count_if((label == 0) & (predicted == 1)).alias("fp"),
        F.count_if((label == 1) & (predicted == 0)).alias("fn"),
        F.count_if((label == 1) & (predicted == 1)).alias("tp"),
    )


def confusion(df: DataFrame, models: dict[str, str], *by: str) -> DataFrame:
    """Confusion counts of every model in one aggregation.

    ``models`` maps a model name to its prediction column. The models stay
    side by side until a few counts are left and only those are stacked, so the
    rows are read once, not once per model.
    """
    names = list(models)
    wide = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *[_cells(models[name]).alias(f"cells_{i}") for i, name in enumerate(names)]
    )
    stacked = F.array(
        *[F.struct(F.lit(name).alias("model"), F.col(f"cells_{i}").alias("cells")) for i, name in enumerate(names)]
    )
    return wide.select(*by, "n", F.inline(stacked)).select(*by, "model", "n", "cells.*")


def _rate(hits: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(hits.cast("double"), total.cast("double")), F.lit(0.0))


def with_rates(counts: DataFrame) -> DataFrame:
    """Add accuracy, precision and recall (0 where undefined).

    ``aligned_accuracy`` gives each predicted class its majority label, the
    fair reading of cluster ids, which have no order of their own.
    """
    tn, fp, fn, tp, n = (F.col(c) for c in ("tn", "fp", "fn", "tp", "n"))
    return (
        counts.withColumn("accuracy", _rate(tp + tn, n))
        .withColumn("precision", _rate(tp, tp + fp))
        .withColumn("recall", _rate(tp, tp + fn))
        .withColumn("aligned_accuracy", _rate(F.greatest(tn, fn) + F.greatest(fp, tp), n))
    )


def mean_accuracy(metrics: DataFrame, literal_divisor: bool = False) -> DataFrame:
    """Mean accuracy over the scored batches of each model.

    ``literal_divisor`` divides by one more than the number of batches, as a
    counter that starts at one does.
    """
    total, batches = F.sum("accuracy"), F.count_distinct("batch_id")
    return metrics.groupBy("model").agg(
        batches.alias("batches"),
        (total / (batches + 1 if literal_divisor else batches)).alias("mean_accuracy"),
    )


def leaderboard(metrics: DataFrame, literal_divisor: bool = False) -> DataFrame:
    """``model, mean_accuracy``, best first; one row per model."""
    return (
        mean_accuracy(metrics, literal_divisor)
        .select("model", "mean_accuracy")
        .orderBy(F.desc("mean_accuracy"), "model")
    )


def batch_counter(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.count_distinct("batch_id").alias("batches"))
