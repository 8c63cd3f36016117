"""Train models over a stream of labelled texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from brooktext.functions.features import TRAIN_WIDTH, with_terms
from brooktext.functions.labels import CLASSES, extend_labels
from brooktext.functions.sizing import on_tasks
from brooktext.streaming.frames import feature_frame, good_records, mark_rejects, parse_batch
from brooktext.streaming.learners import MODELS, PASSES, ModelSet, score_metrics, together, update_models
from brooktext.streaming.lifecycle import BatchRun
from brooktext.streaming.store import ModelStore

MODES = ("post_fit", "pre_fit")
LABEL_MODES = ("stable", "per_batch")


class StreamTrainer:
    """Updates the models batch by batch and reports metrics per batch.

    ``mode='post_fit'`` scores a batch with the models it has just trained;
    ``'pre_fit'`` scores it first, with the models before it.
    ``label_mode='stable'`` keeps one label mapping, the declared ``labels`` in
    order of their classes; it is stored with the models, so a later run need
    not repeat it. A label outside it goes to the dead letters.
    ``'per_batch'`` ranks the labels anew in every batch. ``passes`` is how
    often the local solvers go over a batch (see ``learners``). ``keep_versions`` bounds the model versions kept by a long
    run; ``tasks`` the tasks for the passes over a batch; every ``compact_every``
    batches the small files of their metrics become one (``ModelStore.compact``).
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        width: int = TRAIN_WIDTH,
        models: tuple[str, ...] = MODELS,
        loss: str = "log",
        mode: str = "post_fit",
        label_mode: str = "stable",
        parser: str = "decode",
        keep_versions: int | None = None,
        labels: Sequence[str] | None = None,
        passes: int | None = PASSES,
        tasks: int | None = None,
        compact_every: int | None = None,
    ):
        unknown = set(models) - set(MODELS)
        if unknown or mode not in MODES or label_mode not in LABEL_MODES:
            raise ValueError(f"models {sorted(unknown)} unknown, or mode {mode} or label_mode {label_mode}")
        self.spark = spark
        self.store = ModelStore(spark, root, width)
        self.width, self.models, self.loss = width, tuple(models), loss
        self.mode, self.label_mode, self.parser = mode, label_mode, parser
        self.keep_versions, self.passes, self.tasks = keep_versions, passes, tasks
        self.compact_every = compact_every
        self.labels = self._declared(labels) if label_mode == "stable" else None

    def _declared(self, labels: Sequence[str] | None) -> list[str]:
        stored = self.store.load_labels()
        if labels is None and not stored:
            raise ValueError("a stable label mapping must be declared: labels=(class 0, class 1)")
        if labels is not None and (len(set(labels)) != CLASSES or (stored and list(labels) != stored)):
            raise ValueError(f"labels {list(labels)}: {CLASSES} different ones are needed, as stored: {stored}")
        return stored or list(labels)

    def _marked(self, frame: DataFrame, batch_id: int) -> DataFrame:
        """The persisted frame with label indices; ranks the labels of the batch if they are not declared."""
        if self.labels is not None:
            if self.store.load_labels(batch_id) != self.labels:
                self.store.save_labels(batch_id, self.labels)
            return frame
        labels = extend_labels([], good_records(frame))
        self.store.save_labels(batch_id, labels)
        return mark_rejects(frame, labels)

    def _prior(self, batch_id: int) -> ModelSet:
        return ModelSet(self.store.load_states(batch_id))

    def process(self, batch: DataFrame, batch_id: int) -> bool:
        """Train on one batch; False if it holds no usable row."""
        parsed = parse_batch(batch, self.parser)
        cached = feature_frame(parsed, self.labels, self.width).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            frame = self._marked(cached, batch_id)
            good = F.col("reject").isNull()
            sizes = frame.agg(
                F.count_if(good & (F.col("label") == 0)).alias("n0"),
                F.count_if(good & (F.col("label") == 1)).alias("n1"),
                F.count_if(~good).alias("rejected"),
            ).first()
            if sizes.rejected:
                self.store.save_dead_letters(batch_id, frame.where(~good))
            if sizes.n0 + sizes.n1 == 0:
                return False
            rows = with_terms(on_tasks(frame.where(good), self.tasks), self.width)
            prior = self._prior(batch_id)
            before = []
            if self.mode == "pre_fit" and prior.names():
                # Fetched now: one row per model, before the models move on.
                before = score_metrics(rows, prior).collect()
            updated, fitted = update_models(
                rows, prior, (sizes.n0, sizes.n1), self.models, self.width, self.loss, self.passes
            )
            metrics = self._save_and_score(rows, batch_id, updated)
            self.store.save_metrics(batch_id, before if self.mode == "pre_fit" else metrics, fitted)
            if self.keep_versions is not None:
                self.store.prune(self.keep_versions)
            if self.compact_every and (batch_id + 1) % self.compact_every == 0:
                self.store.compact()
            return True
        finally:
            cached.unpersist()

    def _save_and_score(self, rows: DataFrame, batch_id: int, updated: ModelSet) -> list[Row]:
        """Save the models and score the batch, side by side; returns the metrics, a row per model."""
        tasks = [lambda: self.store.save_states(batch_id, updated.states)] if updated.states else []
        if self.mode == "post_fit" and updated.names():
            return together(self.spark, *tasks, lambda: score_metrics(rows, updated).collect())[-1]
        together(self.spark, *tasks)
        return []

    def start(
        self, stream: DataFrame, checkpoint: str, trigger: dict | None = None, max_batches: int | None = None
    ) -> BatchRun:
        return BatchRun(stream, self.process, checkpoint, trigger, max_batches)

    def metrics(self) -> DataFrame:
        return self.store.metrics()
