"""A streaming source whose offsets count rows, so that a trigger admits so many rows of any files.

The built-in file source takes whole files; a rate in rows then needs a file
for each portion. Here the files are numbered once by a Spark job (rows before
each file), and an offset is a row number over all of them: a trigger takes the next
``rowsPerTrigger`` rows, cut out of one file or several. A micro-batch has a task for
each file it touches and ``ROWS_PER_TASK`` rows of it.

Executors read the files through Arrow, so they must lie where Arrow's file
systems reach (``file``, ``hdfs``, ``s3``, ``gs``); only the rows asked for leave the
reader, and row groups outside them are not read. Rows before them in their row
group are decoded, so files of small row groups (``ROWS_PER_GROUP``) keep a trigger's work the same
however large the files are.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from brooktext.sources.feed import FEED_ROWS

NAME = "brooktext_rows"
ROWS_PER_TASK = 100_000
# Rows of a row group in files staged for such a stream.
ROWS_PER_GROUP = 20_000


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def _read_text(path: str) -> str | None:
    fs, place = _open(path)
    if fs.get_file_info(place).type == pafs.FileType.NotFound:
        return None
    with fs.open_input_stream(place) as source:
        return source.read().decode()


def _write_text(path: str, text: str) -> None:
    """Written beside and moved into place, so that a reader never sees half of it."""
    fs, place = _open(path)
    fs.create_dir(os.path.dirname(place), recursive=True)
    beside = f"{place}.{time.time_ns()}"
    with fs.open_output_stream(beside) as sink:
        sink.write(text.encode())
    fs.move(beside, place)


class Rows(InputPartition):
    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


class RowOffsetReader(DataSourceStreamReader):
    """Offsets are ``{"row": n}``. ``planned`` in the progress file is the end of the last batch planned:
    Spark does not tell a restarted source where it was."""

    def __init__(self, index: list[list], names: list[str], rows: int, progress: str):
        self.index, self.names, self.rows, self.progress = index, names, rows, progress
        self.total = index[-1][1] + index[-1][2] if index else 0
        held = _read_text(progress)
        self.planned = json.loads(held)["planned"] if held else 0

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        return {"row": min(self.planned + self.rows, self.total)}

    def partitions(self, start: dict, end: dict) -> list[Rows]:
        if end["row"] > self.planned:
            self.planned = end["row"]
            _write_text(self.progress, json.dumps({"planned": self.planned}))
        parts = []
        for path, before, n in self.index:
            first, last = max(start["row"] - before, 0), min(end["row"] - before, n)
            parts += [Rows(path, a, min(a + ROWS_PER_TASK, last)) for a in range(first, last, ROWS_PER_TASK)]
        return parts or [Rows("", 0, 0)]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        if partition.first >= partition.last:
            return
        fs, place = _open(partition.path)
        with pq.ParquetFile(place, filesystem=fs) as file:
            seen = 0
            for group in range(file.num_row_groups):
                n = file.metadata.row_group(group).num_rows
                if seen >= partition.last:
                    return
                if seen + n > partition.first:
                    at = seen
                    for batch in file.iter_batches(row_groups=[group], columns=self.names):
                        a, b = max(partition.first - at, 0), min(partition.last - at, batch.num_rows)
                        if a < b:
                            yield batch.slice(a, b - a).select(self.names)
                        at += batch.num_rows
                        if at >= partition.last:
                            return
                seen += n

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class RowOffsetSource(DataSource):
    """Options: ``index`` (JSON file of path, rows before, rows), ``schema``, ``rowsPerTrigger``, ``progress``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return self.options["schema"]

    def streamReader(self, schema) -> RowOffsetReader:
        index = json.loads(_read_text(self.options["index"]))
        return RowOffsetReader(index, schema.fieldNames(), int(self.options["rowspertrigger"]), self.options["progress"])


def number_rows(spark: SparkSession, path: str) -> list[list]:
    """``[file, rows before it, rows]`` of the Parquet files at ``path``, in order of name; one row a file is fetched."""
    counts = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n")).orderBy("file")
    index, before = [], 0
    for row in counts.toLocalIterator():
        index.append([row.file, before, row.n])
        before += row.n
    return index


def row_stream(
    spark: SparkSession, path: str, state: str, rows_per_trigger: int = FEED_ROWS, columns: list[str] | None = None
) -> DataFrame:
    """The rows of the Parquet files at ``path``, ``rows_per_trigger`` of them in a micro-batch; only ``columns`` are read.

    ``state`` is a folder of this stream's own, beside its checkpoint: it keeps
    the numbering of the files, made at the first start, and the last row
    planned, so a restart goes on where the stream was.
    """
    state = state.rstrip("/")
    if _read_text(f"{state}/index.json") is None:
        _write_text(f"{state}/index.json", json.dumps(number_rows(spark, path)))
    spark.dataSource.register(RowOffsetSource)
    given = spark.read.parquet(path)
    given = given if columns is None else given.select(*columns)
    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in given.schema)
    reader = spark.readStream.format(NAME).option("index", f"{state}/index.json").option("progress", f"{state}/planned.json")
    return reader.option("schema", schema).option("rowsPerTrigger", rows_per_trigger).load()
