"""Label indices: per batch, or fitted once and kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the learners know two classes, 0.0 and 1.0.
CLASSES = 2


def label_frequency(records: DataFrame, *by: str) -> DataFrame:
    return records.groupBy(*by, "sentiment").agg(F.count(F.lit(1)).alias("n"))


def label_index_per_batch(records: DataFrame) -> DataFrame:
    """``batch_id, sentiment, n, label``: rank by (count desc, label asc).

    The window sees one row per batch and label, after the counts are combined.
    """
    order = Window.partitionBy("batch_id").orderBy(F.desc("n"), "sentiment")
    return label_frequency(records, "batch_id").withColumn(
        "label", (F.row_number().over(order) - 1).cast("double")
    )


def index_batches(records: DataFrame) -> DataFrame:
    """``records`` with the label index of their own batch."""
    index = label_index_per_batch(records).drop("n")
    return records.join(index, ["batch_id", "sentiment"])


def top_labels(records: DataFrame, known: list[str], classes: int = CLASSES) -> DataFrame:
    """Known labels first, then the most frequent new ones: ``sentiment, n``.

    At most ``classes`` rows, taken per partition and merged, however many
    different labels dirty data holds.
    """
    known_first = [F.col("sentiment").isin(known).desc()] if known else []
    return label_frequency(records).orderBy(*known_first, F.desc("n"), "sentiment").limit(classes)


def extend_labels(known: list[str], records: DataFrame, classes: int = CLASSES) -> list[str]:
    """``known`` labels keep their index; new ones take the free indices.

    The list is bounded by ``classes``. Labels beyond it are left to the dead
    letter table.
    """
    if len(known) >= classes:
        return known
    found = [row.sentiment for row in top_labels(records, known, classes).collect()]
    return known + [label for label in found if label not in known][: classes - len(known)]


def stable_index(labels: list[str], sentiment: str = "sentiment") -> Column:
    """Index of the label in a stored mapping; NULL for an unseen label."""
    index = F.lit(None).cast("double")
    for position, label in reversed(list(enumerate(labels))):
        index = F.when(F.col(sentiment) == label, float(position)).otherwise(index)
    return index
