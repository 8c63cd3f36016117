"""From a micro-batch of lines or records to the cached feature frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooktext.functions.features import hash_features
from brooktext.functions.labels import stable_index
from brooktext.functions.text import record_id
from brooktext.sources.wire import HEADER_LABEL, parse_wire, split_wire_literally


def parse_batch(batch: DataFrame, parser: str = "decode") -> DataFrame:
    """Lines or ready records as ``record, sentiment, message, reject``, no headers."""
    if "value" not in batch.columns:
        record = F.concat_ws(",", "sentiment", "message")
        missing = F.col("sentiment").isNull() | F.col("message").isNull()
        parsed = batch.withColumns({"record": record, "reject": F.when(missing, "null_record")})
    elif parser == "decode":
        parsed = parse_wire(batch)
    elif parser == "literal":
        parsed = split_wire_literally(batch).withColumns(
            {"record": F.col("sentiment"), "reject": F.when(F.col("message").isNull(), "no_separator")}
        )
    else:
        raise ValueError("parser must be 'decode' or 'literal'")
    return parsed.where(F.col("reject").isNotNull() | (F.col("sentiment") != HEADER_LABEL))


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject").isNull())


def mark_rejects(parsed: DataFrame, labels: list[str]) -> DataFrame:
    """Add ``label``; a record whose label is not in the mapping is rejected."""
    label = stable_index(labels)
    return parsed.withColumns(
        {"label": label, "reject": F.coalesce("reject", F.when(label.isNull(), "unknown_label"))}
    )


def feature_frame(parsed: DataFrame, labels: list[str] | None, width: int) -> DataFrame:
    """``row_id, sentiment, label, features, record, reject``.

    Rejected rows stay in the frame, marked and without features, so that one
    read of the batch serves both training and the dead letter table. Without
    ``labels`` there is no ``label`` yet and every row keeps its record, as any
    label may still be rejected by ``mark_rejects``.
    """
    if "row_id" not in parsed.columns:
        parsed = parsed.withColumn("row_id", record_id(F.col("sentiment"), F.col("message")))
    marked = parsed if labels is None else mark_rejects(parsed, labels)
    good = F.col("reject").isNull()
    record = F.coalesce("record", "sentiment")
    marked = marked.select(
        "row_id",
        "sentiment",
        *(["label"] if labels is not None else []),
        "reject",
        F.when(good, F.col("message")).alias("message"),
        (record if labels is None else F.when(~good, record)).alias("record"),
    )
    return hash_features(marked, width)
