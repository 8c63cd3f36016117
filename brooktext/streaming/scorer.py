"""Score saved models over a stream of labelled texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooktext.functions.features import with_terms
from brooktext.functions.labels import extend_labels
from brooktext.functions.metrics import leaderboard
from brooktext.functions.sizing import on_tasks
from brooktext.streaming.frames import feature_frame, good_records, mark_rejects, parse_batch
from brooktext.streaming.learners import MODELS, ModelSet, score_metrics, stacked_predictions
from brooktext.streaming.lifecycle import BatchRun
from brooktext.streaming.store import ModelStore

PREDICTION_SCHEMA = "model string, row_id bigint, label double, prediction double, batch_id bigint"


class StreamScorer:
    """Scores each batch with the latest saved models, without changing them.

    ``labels`` replaces the stored mapping, ``tasks`` bounds the tasks of a
    batch. Results go to tables of their own below ``name``, so several runs can score
    the same models.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        width: int | None = None,
        models: tuple[str, ...] = MODELS,
        name: str = "scores",
        label_mode: str = "stable",
        parser: str = "decode",
        keep_predictions: bool = False,
        labels: Sequence[str] | None = None,
        tasks: int | None = None,
    ):
        self.spark = spark
        self.store = ModelStore(spark, root, width)
        self.name, self.label_mode, self.parser = name, label_mode, parser
        self.keep_predictions = keep_predictions
        states = self.store.load_states()
        self.models = ModelSet({model: state for model, state in states.items() if model in models})
        if not self.models.names():
            raise FileNotFoundError(f"no complete models at {root}")
        self.labels = list(labels or self.store.load_labels()) if label_mode == "stable" else None
        self.tasks = tasks

    def process(self, batch: DataFrame, batch_id: int) -> bool:
        parsed = parse_batch(batch, self.parser)
        cached = feature_frame(parsed, self.labels, self.store.width).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            frame = cached if self.labels is not None else mark_rejects(cached, extend_labels([], good_records(cached)))
            good = F.col("reject").isNull()
            sizes = frame.agg(F.count_if(good).alias("n"), F.count_if(~good).alias("rejected")).first()
            if sizes.rejected:
                self.store.save_dead_letters(batch_id, frame.where(~good), f"{self.name}_dead_letters")
            if sizes.n == 0:
                return False
            rows = with_terms(on_tasks(frame.where(good), self.tasks), self.store.width)
            if self.keep_predictions:
                path = f"{self.store.root}/{self.name}_predictions/batch_id={batch_id}"
                stacked_predictions(rows, self.models).write.mode("overwrite").parquet(path)
            self.store.save_metrics(batch_id, score_metrics(rows, self.models).collect(), [], self.name)
            return True
        finally:
            cached.unpersist()

    def start(
        self, stream: DataFrame, checkpoint: str, trigger: dict | None = None, max_batches: int | None = None
    ) -> BatchRun:
        return BatchRun(stream, self.process, checkpoint, trigger, max_batches)

    def metrics(self) -> DataFrame:
        return self.store.metrics(self.name)

    def predictions(self) -> DataFrame:
        return self.spark.read.schema(PREDICTION_SCHEMA).parquet(f"{self.store.root}/{self.name}_predictions")

    def leaderboard(self, literal_divisor: bool = False) -> DataFrame:
        return leaderboard(self.metrics(), literal_divisor)
