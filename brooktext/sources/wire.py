"""Wire lines: one text line is a JSON array of ``<sentiment>,<message>\\n``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooktext.functions.text import cut_newline, prefix_drop, split_first

# Fixed values of the wire format.
HEADER_RECORD = "Sentiment,Tweet"
HEADER_LABEL = "Sentiment"
RECORD_SEPARATOR = '\\n",'
RECORD_PREFIX = 2
# Between two records of a line: the newline that ends one, its quote, and the quote of the next.
RECORD_BORDER = '\\n", "'


def json_string(value: Column) -> Column:
    """``value`` as a quoted JSON string."""
    # Inside the array's brackets stands a quote, so trimming stops there.
    return F.btrim(F.to_json(F.array(value)), F.lit("[]"))


def to_wire(records: DataFrame, chunk: str) -> DataFrame:
    """One line per chunk, header element first, records in ``row_id`` order.

    A chunk is an id range, so the list built for it is bounded by the range.
    """
    quoted = json_string(F.concat("sentiment", F.lit(","), "message", F.lit("\n")))
    return (
        records.select(chunk, "row_id", quoted.alias("quoted"))
        .groupBy(chunk)
        .agg(F.array_sort(F.collect_list(F.struct("row_id", "quoted"))).alias("rows"))
        .select(
            chunk,
            F.concat(
                F.lit("["),
                json_string(F.lit(HEADER_RECORD + "\n")),
                F.lit(", "),
                F.array_join(F.col("rows.quoted"), ", "),
                F.lit("]"),
            ).alias("value"),
        )
    )


def parse_wire(lines: DataFrame) -> DataFrame:
    """Decode lines to ``record, sentiment, message, reject``.

    ``reject`` is NULL for a good record, else the reason. Nothing is dropped
    here: a NULL line, a line that is no JSON array or goes on after its end,
    an element that is no string and a record without a comma come out as
    rejected rows, so one bad record never costs the batch. Other columns of
    ``lines`` are kept.
    """
    kept = [name for name in lines.columns if name != "value"]
    # As the only element of an array, a line must end where its own array ends.
    outer = F.try_parse_json(F.concat(F.lit("["), "value", F.lit("]"))).cast("array<variant>")
    only = F.when(F.size(outer) == 1, F.try_variant_get(F.get(outer, F.lit(0)), "$", "array<variant>"))
    elements = F.transform(
        "items",
        lambda item: F.struct(
            F.when(F.schema_of_variant(item) != "VOID", F.coalesce(F.try_variant_get(item, "$", "string"), F.to_json(item))).alias("raw"),
            F.schema_of_variant(item).alias("kind"),
        ),
    )
    whole = F.array(F.struct(F.col("value").alias("raw"), F.lit("LINE").alias("kind")))
    decoded = lines.withColumn("items", only)
    exploded = decoded.select(*kept, F.inline(F.coalesce(elements, whole)))
    # The tests look at the raw text, so that a filter on them copies nothing.
    reject = (
        F.when(F.col("kind") == "LINE", "not_json")
        .when(F.coalesce("kind", F.lit("VOID")) == "VOID", "null_record")
        .when(F.col("kind") != "STRING", "not_a_string")
        .when(F.instr("raw", ",") == 0, "no_separator")
    )
    sentiment, message = split_first(F.col("raw"), ",")
    return exploded.select(
        *kept,
        cut_newline(F.col("raw")).alias("record"),
        cut_newline(sentiment).alias("sentiment"),
        cut_newline(message).alias("message"),
        reject.alias("reject"),
    )


def read_long_lines(spark: SparkSession, path: str, border: str = RECORD_BORDER) -> DataFrame:
    """Wire files as many short wire lines (``value``), for ``parse_wire``; a long line is read by many tasks.

    Spark cuts a file into byte ranges at its line separator. With the border
    between two records as the separator, a range ends at a record, however
    long the line is. A quote inside a record is escaped, so the border cannot
    be part of one. Each piece is made a line of its own again; a piece with
    other borders, as another sender may write them, is a line of several records.
    Lines still end at newlines; empty ones are left out. A damaged line loses
    its damaged records only, where ``parse_wire`` on whole lines rejects all of it.
    """
    pieces = spark.read.option("lineSep", border).text(path).select("value", F.col("_metadata.file_size").alias("file_size"))
    split = pieces.select(F.split("value", "\n").alias("parts"), (F.octet_length("value") + 1 >= F.col("file_size")).alias("all"))
    parts = split.select("all", (F.size("parts") - 1).alias("last"), F.posexplode("parts").alias("i", "part")).where(F.trim("part") != "")
    opened, closed = F.col("part").rlike(r'^\s*\["'), F.col("part").rlike(r'"\]\s*$')
    # Newlines tell where a line begins and ends; there it must do so like a list of strings, else the parser gets it as it is.
    begins, ends = F.col("all") | (F.col("i") > 0), F.col("all") | (F.col("i") < F.col("last"))
    foreign = (begins & ~opened) | (ends & ~closed)
    body = F.regexp_replace(F.regexp_replace("part", r'^\s*\["', ""), r'(\\n)?"\]\s*$', "")
    return parts.select(F.when(foreign, F.col("part")).otherwise(F.concat(F.lit('["'), body, F.lit('"]'))).alias("value"))


def split_wire_literally(lines: DataFrame) -> DataFrame:
    """Cut lines as plain text, without decoding JSON.

    Escapes stay in the message and the last record of a line keeps its tail.
    """
    kept = [name for name in lines.columns if name != "value"]
    pieces = lines.select(
        *kept, F.explode(F.split("value", RECORD_SEPARATOR.replace("\\", "\\\\"))).alias("piece")
    )
    sentiment, message = split_first(prefix_drop(F.col("piece"), RECORD_PREFIX), ",")
    return pieces.select(*kept, sentiment.alias("sentiment"), message.alias("message"))


def drop_headers(records: DataFrame) -> DataFrame:
    """Rows whose label is not the header word; NULL labels go too."""
    return records.where(F.col("sentiment") != HEADER_LABEL)


def drop_nulls(records: DataFrame) -> DataFrame:
    return records.na.drop(subset=["sentiment", "message"])
