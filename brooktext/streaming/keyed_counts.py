"""Counts by key: within each micro-batch and since the start."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooktext.functions.text import field_at
from brooktext.streaming.lifecycle import BatchRun


def keyed_lines(lines: DataFrame, position: int = 0, separator: str = ";") -> DataFrame:
    """``key`` of each line: its first field, or the one at ``position``."""
    return lines.select(field_at(F.col("value"), position, separator).alias("key"))


def count_by_key(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by, "key").agg(F.count(F.lit(1)).alias("n"))


def _write_batch(table: DataFrame, path: str, batch_id: int) -> bool:
    """Write a batch's counts; False if there are none, so that the batch does not count."""
    target = f"{path}/batch_id={batch_id}"
    table.write.mode("overwrite").parquet(target)
    return not table.sparkSession.read.schema(table.schema).parquet(target).isEmpty()


def start_batch_counts(keys: DataFrame, path: str, checkpoint: str, **run) -> BatchRun:
    """Write ``key, n`` of every micro-batch below ``batch_id=k``."""

    def handle(batch: DataFrame, batch_id: int) -> bool:
        return _write_batch(count_by_key(batch), path, batch_id)

    return BatchRun(keys.select("key"), handle, checkpoint, **run)


def start_running_counts(keys: DataFrame, path: str, checkpoint: str, emit: str = "all", **run) -> BatchRun:
    """Write ``key, total`` since the start, at every micro-batch.

    Spark keeps the totals in its checkpointed state store. ``emit='all'`` gives
    every key each time; ``'changed'`` only those of the batch, the better
    choice for very many keys.
    """
    totals = keys.groupBy("key").agg(F.count(F.lit(1)).alias("total"))

    def handle(batch: DataFrame, batch_id: int) -> bool:
        return _write_batch(batch, path, batch_id)

    mode = {"all": "complete", "changed": "update"}[emit]
    return BatchRun(totals, handle, checkpoint, output_mode=mode, **run)


def read_counts(spark: SparkSession, path: str, value: str) -> DataFrame:
    return spark.read.schema(f"key string, {value} bigint, batch_id bigint").parquet(path)
