"""The given tables, seen as labelled records and as keyed events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooktext.functions.features import hash_features

# A feeder ships records in id order, so an arrival batch is a contiguous id
# range. Numbering by range needs no sort and no shuffle.
RECORD_IDS_PER_BATCH = 250
EVENTS_PER_BATCH = 2000
# Session setting: tasks to deal the rows of text tables out to; not set, they stay as scanned.
SPREAD_SETTING = "spark.brooktext.spread.tasks"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_batch(key: str | Column, size: int) -> Column:
    """Arrival batch of an id: the id range of length ``size`` it falls in."""
    key = F.col(key) if isinstance(key, str) else key
    return F.call_function("div", key, F.lit(size))


def read_text_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a text table, as scanned.

    A table in one small file is read by a single task. A caller who has such
    tables can set ``SPREAD_SETTING`` to a number of tasks to deal the rows out to.
    """
    df = read_table(spark, sf_dir, name).select(*columns)
    tasks = spark.conf.get(SPREAD_SETTING, None)
    return df.repartition(int(tasks)) if tasks else df


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled records: ``row_id, sentiment, message``.

    No join hint: the optimizer broadcasts the labels while they are below its
    size threshold and sorts or hashes both sides by id beyond it.
    """
    documents = read_text_table(spark, sf_dir, "documents", "doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id").select(
        F.col("doc_id").alias("row_id"),
        F.col("quality").cast("string").alias("sentiment"),
        F.col("text").alias("message"),
    )


def hashed_records(spark: SparkSession, sf_dir: str, width: int) -> DataFrame:
    """Labelled records with hashed term counts: ``row_id, sentiment, features``.

    Documents are hashed where they are read. What the join moves, if the
    labels are too large to be broadcast, is the counts and never the text.
    """
    documents = read_text_table(spark, sf_dir, "documents", "doc_id", "text")
    hashed = hash_features(documents.withColumnRenamed("text", "message"), width)
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return hashed.join(labels, "doc_id").select(
        F.col("doc_id").alias("row_id"), F.col("quality").cast("string").alias("sentiment"), "features"
    )


def labelled_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id, batch_id, sentiment`` of the labels alone; no text is read."""
    return read_table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("row_id"),
        id_batch("doc_id", RECORD_IDS_PER_BATCH).alias("batch_id"),
        F.col("quality").cast("string").alias("sentiment"),
    )


def keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id, batch_id, key`` of the event stream."""
    return read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"),
        id_batch("event_id", EVENTS_PER_BATCH).alias("batch_id"),
        F.col("event_type").alias("key"),
    )
