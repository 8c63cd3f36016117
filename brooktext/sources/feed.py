"""Streaming sources: text lines and the delimited tweet feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The 14 columns of the feed, in order.
TWEET_SCHEMA = T.StructType(
    [
        T.StructField("ID", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("Date", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("len", T.IntegerType()),
        T.StructField("likes", T.IntegerType()),
        T.StructField("RTs", T.IntegerType()),
        T.StructField("Hashtags", T.StringType()),
        T.StructField("Usernames", T.StringType()),
        T.StructField("Userid", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("Place", T.StringType()),
        T.StructField("followers", T.LongType()),
        T.StructField("friends", T.LongType()),
    ]
)

# The ports, trigger intervals and feed rate in use.
MODEL_PORT = 6100
COUNT_PORT = 9009
MODEL_INTERVAL = "5 seconds"
COUNT_INTERVAL = "2 seconds"
FEED_ROWS = 2000


def line_stream(spark: SparkSession, kind: str = "text", **options: str) -> DataFrame:
    """Unbounded lines as ``value string``.

    ``kind`` is ``text`` (a folder, option ``path``), ``socket`` (``host``,
    ``port``) or ``kafka``. A socket keeps no offsets and has one reader; use it
    for trials only.
    """
    reader = spark.readStream.format(kind)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load().selectExpr("CAST(value AS STRING) AS value")


def text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of the files in a folder; ``max_files`` limits a micro-batch."""
    options = {"path": path}
    if max_files is not None:
        options["maxFilesPerTrigger"] = str(max_files)
    return line_stream(spark, "text", **options)


def csv_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TWEET_SCHEMA,
    sep: str = ";",
    header: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    """Rows of the delimited files in a folder, with a declared schema."""
    reader = spark.readStream.schema(schema).option("sep", sep).option("header", header)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path)


def to_feed(events: DataFrame) -> DataFrame:
    """Events in the 14 feed columns; columns they lack are empty."""
    given = {
        "ID": "CAST(event_id AS STRING)",
        "language": "event_type",
        "Date": "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
        "Userid": "CAST(user_id AS STRING)",
        "len": "CAST(length(props) AS INT)",
        "followers": "user_id",
    }
    return events.selectExpr(
        *[
            f"{given.get(field.name, f'CAST(NULL AS {field.dataType.simpleString()})')} AS `{field.name}`"
            for field in TWEET_SCHEMA
        ]
    )
