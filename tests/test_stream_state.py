"""Row offsets, the progress table and keyed state, with restarts."""

import datetime

import pytest
from pyspark.sql import functions as F

from brooktext.sources import row_offsets
from brooktext.sources.workspace import new_folder
from brooktext.streaming import keyed_state
from brooktext.streaming.lifecycle import BatchRun
from brooktext.streaming.progress import ProgressTable

ONWARD = {"processingTime": "0 seconds"}


def counted(seen):
    def handle(batch, batch_id):
        seen[batch_id] = sorted(r.id for r in batch.select("id").collect())
        return True

    return handle


def test_a_trigger_admits_so_many_rows_of_any_files(spark):
    path, state, checkpoint = (new_folder(spark, p) for p in ("rows", "offsets", "checkpoint"))
    # Files of 17, 1 and 12 rows.
    for first, last in ((0, 17), (17, 18), (18, 30)):
        spark.range(first, last).select("id", F.lit("x").alias("text")).coalesce(1).write.mode("append").parquet(path)
    seen = {}
    run = BatchRun(row_offsets.row_stream(spark, path, state, 8), counted(seen), checkpoint, ONWARD, max_batches=2)
    run.wait(timeout=60)
    assert run.limited and [len(seen[k]) for k in sorted(seen)] == [8, 8]
    # A restart goes on after the last row, not at a file border and not anew.
    run = BatchRun(row_offsets.row_stream(spark, path, state, 8), counted(seen), checkpoint, ONWARD)
    run.drain()
    assert [len(seen[k]) for k in sorted(seen)] == [8, 8, 8, 6]
    assert sorted(x for rows in seen.values() for x in rows) == list(range(30))
    # Nothing is left for a third.
    before = dict(seen)
    BatchRun(row_offsets.row_stream(spark, path, state, 8), counted(seen), checkpoint, ONWARD).drain()
    assert seen == before


def test_no_rows_give_no_batch(spark):
    path, state, checkpoint = (new_folder(spark, p) for p in ("rows", "offsets", "checkpoint"))
    spark.range(0).write.parquet(path)
    seen = {}
    BatchRun(row_offsets.row_stream(spark, path, state, 8), counted(seen), checkpoint, ONWARD).drain()
    assert not any(seen.values())


def test_progress_of_a_batch_told_twice_counts_once(spark):
    path, landing, checkpoint = (new_folder(spark, p) for p in ("progress", "rows", "checkpoint"))
    spark.range(5).write.parquet(landing)
    progress = ProgressTable(spark, path)
    assert progress.table().collect() == []
    with progress:
        BatchRun(spark.readStream.schema("id bigint").parquet(landing), counted({}), checkpoint).wait()
    (row,) = progress.table().collect()
    assert (row.batch_id, row.n_rows) == (0, 5) and row.milliseconds > 0
    again = row.asDict() | {"told_at": 99, "n_rows": 6}
    progress._held.append(again)
    progress.flush()
    assert [(r.batch_id, r.n_rows) for r in progress.table().collect()] == [(0, 6)]


def at(minute):
    return datetime.datetime(2024, 1, 1, 12, 0) + datetime.timedelta(minutes=minute)


def test_keys_expire_and_start_anew_across_restarts(spark):
    landing, out, checkpoint = (new_folder(spark, p) for p in ("events", "states", "checkpoint"))
    schema = "key string, value bigint, at timestamp"

    def start():
        stream = spark.readStream.schema(schema).parquet(landing).withWatermark("at", "0 seconds")
        states = keyed_state.running_state(
            stream, ["key"], keyed_state.sum_and_max, "n bigint, total bigint, most bigint", time="at", expire_ms=10 * 60_000
        )
        return keyed_state.start_running_state(states, out, checkpoint)

    # Each arrival is read by a query of its own on the same checkpoint.
    for rows in (
        [("a", 1, at(0)), ("a", 5, at(1)), ("b", None, at(1)), (None, 7, at(1))],
        [("a", 2, at(8)), ("c", 1, at(9))],
        [("c", 1, at(15))],  # past minute 11: b and the null key go; a has until 18
        [("c", 4, at(30))],
        [("a", 9, at(31))],
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        start().wait()
    found = spark.read.parquet(out).collect()
    live = {(r.key, r.n, r.total, r.most) for r in found if not r.expired}
    assert {("a", 2, 6, 5), ("b", 1, 0, None), (None, 1, 7, 7), ("a", 3, 8, 5), ("c", 1, 1, 1), ("c", 2, 2, 1), ("a", 1, 9, 9)} <= live
    assert {(r.key, r.n, r.total) for r in found if r.expired} >= {("a", 3, 8), ("b", 1, 0), (None, 1, 7)}


def test_any_function_keeps_state(spark):
    landing, out, checkpoint = (new_folder(spark, p) for p in ("events", "states", "checkpoint"))
    longest = lambda state, rows: (max([state[0] if state else "", *rows["word"]], key=len),)
    for words in (["aa", "b"], ["cccc", "d"], ["eee"]):
        spark.createDataFrame([(w,) for w in words], "word string").coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema("word string").parquet(landing).withColumn("key", F.lit(1))
        states = keyed_state.running_state(stream, ["key"], longest, "longest string")
        keyed_state.start_running_state(states, out, checkpoint).wait()
    rows = spark.read.parquet(out).orderBy("batch_id").collect()
    assert [r.longest for r in rows] == ["aa", "cccc", "cccc"] and not any(r.expired for r in rows)
    with pytest.raises(ValueError, match="key"):
        keyed_state.running_state(stream, ["key"], longest, "key string")


def test_a_trigger_decodes_no_more_than_it_takes(spark, monkeypatch):
    path, state = new_folder(spark, "rows"), new_folder(spark, "offsets")
    table = spark.range(60).selectExpr("id", "CAST(id AS STRING) AS name").coalesce(1)
    table.write.option("parquet.block.row.count.limit", 20).parquet(path)
    index = row_offsets.number_rows(spark, path)
    groups = []

    class Counted(row_offsets.pq.ParquetFile):
        def iter_batches(self, row_groups, columns):
            for batch in super().iter_batches(batch_size=5, row_groups=row_groups, columns=columns):
                groups.append((row_groups[0], batch.num_columns))
                yield batch

    monkeypatch.setattr(row_offsets.pq, "ParquetFile", Counted)
    reader = row_offsets.RowOffsetReader(index, ["id"], 8, f"{state}/planned.json")
    got = [v for part in reader.partitions({"row": 22}, {"row": 30}) for b in reader.read(part) for v in b.column(0).to_pylist()]
    assert got == list(range(22, 30))
    assert groups == [(1, 1), (1, 1)]


def test_progress_is_taken_from_one_call_an_event(spark, monkeypatch):
    from pyspark.sql.streaming.listener import StreamingQueryProgress

    def by_field(cls, event):
        raise AssertionError("one call for each field of the event")

    monkeypatch.setattr(StreamingQueryProgress, "fromJObject", classmethod(by_field))
    path, state, checkpoint, out = (new_folder(spark, p) for p in ("rows", "offsets", "checkpoint", "progress"))
    spark.range(20).write.parquet(path)
    with ProgressTable(spark, out) as progress:
        BatchRun(row_offsets.row_stream(spark, path, state, 8, ["id"]), counted({}), checkpoint, ONWARD).drain()
    assert sorted((r["batch_id"], r["n_rows"]) for r in progress.table().collect()) == [(0, 8), (1, 8), (2, 4)]
