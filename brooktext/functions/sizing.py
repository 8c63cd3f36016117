"""Tasks for the passes over a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame


def on_tasks(df: DataFrame, tasks: int | None) -> DataFrame:
    """``df`` on at most ``tasks`` tasks, if the caller asks for that; never shuffles.

    For small micro-batches and learners that pass over the rows dozens of
    times, where each task costs each time. Without it the rows stay as read.
    """
    return df if tasks is None else df.coalesce(tasks)
