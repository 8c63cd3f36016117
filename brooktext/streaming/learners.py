"""The five models of a batch: update them together, score them together."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooktext.functions.linear import decide, sparse_dot
from brooktext.functions.metrics import confusion, with_rates
from brooktext.functions.features import with_norm
from brooktext.operators import kmeans, linear_sgd, logistic, naive_bayes, perceptron
from brooktext.operators.local_steps import PASSES, local_updates
from brooktext.operators.sums import State, fetch_sums, slot_sums

# The model names, in report order.
MODELS = ("LR", "SGD", "MLP", "MNB", "KMEANS")
LOCAL = ("SGD", "MLP")


@dataclass
class ModelSet:
    """Models after some batch, as named vectors."""

    states: dict[str, State] = field(default_factory=dict)

    def names(self) -> list[str]:
        return [name for name in MODELS if name in self.states]


def together(spark: SparkSession, *tasks: Callable) -> list:
    """Run independent Spark actions at the same time; results in order.

    The learners of a batch submit many short jobs over the same cached rows;
    side by side they fill the gaps in each other's stages.
    """
    in_session = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        futures = [pool.submit(in_session(task)) for task in tasks]
        return [future.result() for future in futures]


def update_linear(
    rows: DataFrame, prior: dict[str, State], models: tuple[str, ...], width: int, loss: str
) -> dict[str, State]:
    """Naive Bayes, the linear classifier and k-means from one aggregation."""
    coefficients: dict[str, Column] = {}
    margins: dict[str, Column] = {}
    if "MNB" in models:
        coefficients |= naive_bayes.nb_coefficients()
    if "SGD" in models:
        margins["sgd_margin"] = linear_sgd.sgd_margin(prior.get("SGD"))
        coefficients |= linear_sgd.sgd_coefficients(loss)
    if "KMEANS" in models:
        centres = prior.get("KMEANS") or kmeans.kmeans_start(rows, width)
        margins["kmeans_margin"] = kmeans.kmeans_margin(centres)
        coefficients |= kmeans.kmeans_coefficients()
    if not coefficients:
        return {}
    sums = fetch_sums(slot_sums(rows.withColumns(margins), coefficients), width)
    states: dict[str, State] = {}
    if "MNB" in models:
        states["MNB"] = naive_bayes.nb_update(prior.get("MNB"), sums)
    if "SGD" in models:
        states["SGD"] = linear_sgd.sgd_update(prior.get("SGD"), sums)
    if "KMEANS" in models:
        states["KMEANS"] = kmeans.kmeans_update(centres, sums)
    return states


def update_models(
    rows: DataFrame,
    prior: ModelSet,
    class_sizes: tuple[int, int],
    models: tuple[str, ...] = MODELS,
    width: int = 300,
    loss: str = "log",
    passes: int | None = PASSES,
) -> tuple[ModelSet, list[str]]:
    """Models after this batch, and the names of those that were fitted.

    ``passes``: how often the local solvers go over a batch. Without it the linear
    classifier takes one step over the whole batch, on raw counts, in the
    aggregation that the other linear models use.

    Logistic regression needs both classes in the batch; without them it alone
    is skipped and its previous model stays.
    """
    local = tuple(name for name in LOCAL if name in models and (passes or name == "MLP"))
    shared = tuple(name for name in models if name not in (*local, "LR"))
    tasks = {"linear": lambda: update_linear(rows, prior.states, shared, width, loss)}
    tasks["local"] = lambda: local_updates(rows, prior.states, local, width, loss, passes or PASSES)
    if "LR" in models and min(class_sizes) > 0:
        tasks["LR"] = lambda: {"LR": logistic.lr_fit(rows, width, prior.states.get("LR"))}
    results = dict(zip(tasks, together(rows.sparkSession, *tasks.values()), strict=True))
    fitted = {name: state for part in results.values() for name, state in part.items()}
    kept = {name: prior.states[name] for name in models if name in prior.states}
    return ModelSet(kept | fitted), list(fitted)


def linear_weights(states: dict[str, State]) -> dict:
    makers = {
        "LR": logistic.lr_weights,
        "SGD": linear_sgd.sgd_weights,
        "MNB": naive_bayes.nb_weights,
        "KMEANS": kmeans.kmeans_weights,
    }
    plain = {name: state for name, state in states.items() if name in makers and "scaled" not in state}
    return {name: makers[name](plain[name]) for name in MODELS if name in plain}


def with_predictions(
    rows: DataFrame, models: ModelSet, prefix: str = "prediction"
) -> tuple[DataFrame, dict[str, str]]:
    """Add a prediction column per model; returns the columns by model name."""
    columns = {name: f"{prefix}_{name}" for name in models.names()}
    decisions = {columns[name]: decide(sparse_dot(w)) for name, w in linear_weights(models.states).items()}
    sgd, mlp = models.states.get("SGD"), models.states.get("MLP")
    if mlp or (sgd and "scaled" in sgd):
        rows = with_norm(rows)
    if sgd and "scaled" in sgd:
        decisions[columns["SGD"]] = decide(linear_sgd.scaled_margin(sgd))
    if mlp:
        kept = rows.columns
        rows = perceptron.with_layers(rows, mlp).select(*kept, decide("mlp_margin").alias(columns["MLP"]))
    return rows.withColumns(decisions), columns


def score_metrics(rows: DataFrame, models: ModelSet, *by: str) -> DataFrame:
    """Metrics of all models over the rows, in one aggregation."""
    predicted, columns = with_predictions(rows, models)
    return with_rates(confusion(predicted, columns, *by))


def stacked_predictions(rows: DataFrame, models: ModelSet) -> DataFrame:
    """One row per model and record: ``model, row_id, label, prediction``."""
    predicted, columns = with_predictions(rows, models)
    stacked = F.array(
        *[F.struct(F.lit(name).alias("model"), F.col(column).alias("prediction")) for name, column in columns.items()]
    )
    return predicted.select("row_id", "label", F.inline(stacked)).select("model", "row_id", "label", "prediction")
