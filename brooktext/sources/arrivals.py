"""A stored table as a sequence of arrivals, for replaying it as a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# A fixed number of arrivals: their size grows with the table, their number
# does not.
ARRIVALS = 4


def id_ranges(table: DataFrame, key: str, parts: int = ARRIVALS) -> list[tuple[int, int]]:
    """``parts`` equal id ranges ``[low, high)`` that cover the table."""
    bounds = table.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    if bounds.low is None:
        return []
    size = -(-(bounds.high - bounds.low + 1) // parts)
    return [(bounds.low + i * size, bounds.low + (i + 1) * size) for i in range(parts)]


def in_range(key: str, bounds: tuple[int, int]) -> Column:
    return (F.col(key) >= bounds[0]) & (F.col(key) < bounds[1])


def replay(arrivals: Iterator[DataFrame], land: Callable[[DataFrame], None], start: Callable[[], StreamingQuery]):
    """Land one arrival after the other and let the stream take up each.

    The query is started anew on its checkpoint for every arrival and ends when
    it has read what is there. So an arrival is exactly one micro-batch,
    however many files it has, and every start recovers from the checkpoint.
    """
    for arrival in arrivals:
        land(arrival)
        start().awaitTermination()
