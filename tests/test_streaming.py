import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brooktext.sources import arrivals, feed, wire
from brooktext.sources.workspace import new_folder
from brooktext.streaming import keyed_counts
from brooktext.streaming.lifecycle import BatchRun, start_preview
from brooktext.streaming.scorer import StreamScorer
from brooktext.streaming.store import ModelStore, WidthMismatch
from brooktext.streaming.trainer import StreamTrainer

WIDTH = 50
LABELS = ("4", "0")


def as_lines(df):
    return wire.to_wire(df.withColumn("chunk", F.lit(0)), "chunk").select("value")


def batches_of(records, *id_lists):
    return [records.where(F.col("row_id").isin(ids)) for ids in id_lists]


def table(df):
    return sorted(repr(tuple(row)) for row in df.collect())


def states_of(store):
    rows = store.state_table().collect()
    return {(r.batch_id, r.model, r["name"]): np.array(r.vector) for r in rows}


def metrics_of(trainer):
    return table(trainer.metrics().drop("batch_time"))


# The first part has more rows of label 4, so it fixes the same label order as the whole.
CUT = ([0, 1, 2, 10, 11], [3, 12, 20], [4, 13])


def test_stream_equals_batch_for_additive_models(spark, records):
    landing, checkpoint = new_folder(spark, "wire"), new_folder(spark, "checkpoint")
    trainer = StreamTrainer(spark, new_folder(spark, "models"), WIDTH, ("MNB",), labels=LABELS)
    arrivals.replay(
        (as_lines(batch) for batch in batches_of(records, *CUT)),
        lambda lines: lines.write.mode("append").text(landing),
        lambda: trainer.start(feed.text_stream(spark, landing), checkpoint),
    )
    whole = StreamTrainer(spark, new_folder(spark, "models"), WIDTH, ("MNB",), labels=LABELS)
    whole.process(as_lines(records), 0)
    assert [r.batch_id for r in trainer.metrics().orderBy("batch_id").collect()] == [0, 1, 2]
    for name in ("n0", "n1"):
        np.testing.assert_array_equal(
            states_of(trainer.store)[2, "MNB", name], states_of(whole.store)[0, "MNB", name]
        )


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 2), min_size=10, max_size=10))
def test_naive_bayes_does_not_depend_on_the_cut(spark, records, places):
    ids = [0, 1, 2, 3, 4, 10, 11, 12, 13, 20]
    trainer = StreamTrainer(spark, new_folder(spark, "models"), WIDTH, ("MNB",), labels=LABELS)
    trainer.store.save_labels(0, ["4", "0"])
    trainer.store.save_metrics(0, [], [])
    for place in range(3):
        chosen = [i for i, p in zip(ids, places) if p == place]
        trainer.process(records.where(F.col("row_id").isin(chosen)), place + 1)
    whole = StreamTrainer(spark, new_folder(spark, "models"), WIDTH, ("MNB",), labels=LABELS)
    whole.process(records, 0)
    got, want = trainer.store.load_states()["MNB"], whole.store.load_states()["MNB"]
    np.testing.assert_array_equal(got["n0"], want["n0"])
    np.testing.assert_array_equal(got["n1"], want["n1"])


def test_replayed_batch_changes_nothing(spark, records):
    root = new_folder(spark, "models")
    trainer = StreamTrainer(spark, root, WIDTH, labels=LABELS)
    parts = [as_lines(batch) for batch in batches_of(records, *CUT)]
    for k, part in enumerate(parts):
        assert trainer.process(part, k)
    states, metrics = states_of(trainer.store), metrics_of(trainer)
    restarted = StreamTrainer(spark, root, WIDTH, labels=LABELS)
    restarted.process(parts[1], 1)
    restarted.process(parts[2], 2)
    after = states_of(restarted.store)
    assert states.keys() == after.keys()
    for key in states:
        np.testing.assert_allclose(states[key], after[key])
    assert metrics_of(restarted) == metrics
    assert len(metrics) == 15


def test_empty_and_header_only_batches_are_passed_over(spark, records):
    trainer = StreamTrainer(spark, new_folder(spark, "models"), WIDTH, ("MNB",), labels=LABELS)
    assert not trainer.process(spark.createDataFrame([], "value string"), 0)
    header = spark.createDataFrame([('["Sentiment,Tweet\\n"]',)], "value string")
    assert not trainer.process(header, 1)
    assert trainer.process(as_lines(records), 2)
    assert [(r.batch_id, r.n) for r in trainer.metrics().collect()] == [(2, 10)]


def test_bad_records_do_not_cost_the_batch(spark, records):
    trainer = StreamTrainer(spark, new_folder(spark, "models"), WIDTH, ("MNB",), labels=LABELS)
    trainer.process(as_lines(records), 0)
    bad = spark.createDataFrame(
        [("",), ("plain no comma",), ('["nothing here\\n", "7,other label\\n"]',)], "value string"
    )
    assert trainer.process(as_lines(records).unionByName(bad), 1)
    assert [r.n for r in trainer.metrics().where("batch_id = 1").collect()] == [10]
    dead = trainer.store.dead_letters()
    assert table(dead.select("record", "reject", "batch_id")) == sorted(
        repr(row)
        for row in [
            ("", "not_json", 1),
            ("plain no comma", "not_json", 1),
            ("nothing here", "no_separator", 1),
            ("7,other label", "unknown_label", 1),
        ]
    )


def test_one_class_batch_keeps_the_previous_regression(spark, records):
    trainer = StreamTrainer(spark, new_folder(spark, "models"), WIDTH, ("LR", "MNB"), labels=LABELS)
    trainer.process(records, 0)
    trainer.process(records.where("sentiment = '4'"), 1)
    fitted = {(r.batch_id, r.model): r.fitted for r in trainer.metrics().collect()}
    assert fitted == {(0, "LR"): True, (0, "MNB"): True, (1, "LR"): False, (1, "MNB"): True}


def test_declared_labels_outlive_a_first_batch_of_junk(spark, records):
    trainer = StreamTrainer(spark, new_folder(spark, "models"), WIDTH, ("MNB",), labels=LABELS)
    junk = spark.createDataFrame([(90, "junk", "odd text")], records.schema)
    trainer.process(records.where("sentiment = '0'").union(junk), 0)
    trainer.process(records, 1)
    assert trainer.store.load_labels() == ["4", "0"]
    assert [r.n for r in trainer.metrics().orderBy("batch_id").collect()] == [4, 10]
    assert [(r.record, r.reject) for r in trainer.store.dead_letters().collect()] == [("junk,odd text", "unknown_label")]


def test_stable_labels_must_be_declared_once(spark, records):
    root = new_folder(spark, "models")
    with pytest.raises(ValueError, match="declared"):
        StreamTrainer(spark, root, WIDTH, ("MNB",))
    StreamTrainer(spark, root, WIDTH, ("MNB",), labels=LABELS).process(records, 0)
    assert StreamTrainer(spark, root, WIDTH, ("MNB",)).labels == ["4", "0"]
    with pytest.raises(ValueError, match="stored"):
        StreamTrainer(spark, root, WIDTH, ("MNB",), labels=("0", "4"))


@pytest.mark.parametrize("options", [{"labels": LABELS}, {"label_mode": "per_batch"}])
def test_a_batch_is_read_once(spark, records, options):
    """Every line passes one accumulator each time its source is read."""
    reads = spark.sparkContext.accumulator(0)
    lines = as_lines(records)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    trainer = StreamTrainer(spark, new_folder(spark, "models"), WIDTH, ("MNB",), **options)
    trainer.process(lines.mapInArrow(counted, lines.schema), 0)
    assert reads.value == 1


def test_labels_may_be_ranked_per_batch(spark, records):
    trainer = StreamTrainer(spark, new_folder(spark, "models"), WIDTH, ("MNB",), label_mode="per_batch")
    trainer.process(records, 0)
    assert trainer.store.load_labels() == ["4", "0"]
    trainer.process(records.where("row_id IN (0, 10, 11)"), 1)
    assert trainer.store.load_labels() == ["0", "4"]


def test_scoring_before_training(spark, records):
    trainer = StreamTrainer(spark, new_folder(spark, "models"), WIDTH, ("MNB",), labels=LABELS, mode="pre_fit")
    for k, batch in enumerate(batches_of(records, *CUT)):
        trainer.process(batch, k)
    assert sorted((r.batch_id, r.n) for r in trainer.metrics().collect()) == [(1, 3), (2, 2)]


def test_saved_models_score_a_stream(spark, records):
    root, landing = new_folder(spark, "models"), new_folder(spark, "wire")
    trainer = StreamTrainer(spark, root, WIDTH, labels=LABELS)
    trainer.process(as_lines(records), 0)
    as_lines(records).write.text(landing)
    scorer = StreamScorer(spark, root, keep_predictions=True)
    assert scorer.start(feed.text_stream(spark, landing), new_folder(spark, "checkpoint")).wait() == 1
    columns = ["model", "n", "tn", "fp", "fn", "tp", "accuracy"]
    assert table(scorer.metrics().select(columns)) == table(trainer.metrics().select(columns))
    assert scorer.predictions().count() == 50
    assert scorer.leaderboard().count() == 5


def test_width_is_checked_at_load(spark, records):
    root = new_folder(spark, "models")
    StreamTrainer(spark, root, WIDTH, ("MNB",), labels=LABELS).process(records, 0)
    with pytest.raises(WidthMismatch):
        StreamScorer(spark, root, width=WIDTH + 1)
    with pytest.raises(FileNotFoundError):
        ModelStore(spark, new_folder(spark, "models"))


def test_literal_parser_trains_too(spark, records):
    trainer = StreamTrainer(spark, new_folder(spark, "models"), WIDTH, ("MNB",), labels=LABELS, parser="literal")
    assert trainer.process(as_lines(records), 0)
    assert trainer.metrics().first().n == 10


def staged(spark, n_files):
    landing = new_folder(spark, "lines")
    for i in range(n_files):
        spark.createDataFrame([(f"a;{i}",), (f"b;{i}",)], "value string").coalesce(1).write.mode("append").text(landing)
    return landing


def test_batch_limit_leaves_the_rest_for_the_next_run(spark):
    landing, checkpoint, seen = staged(spark, 4), new_folder(spark, "checkpoint"), []

    def handle(batch, batch_id):
        seen.append((batch_id, batch.count()))
        return True

    def stream():
        return feed.text_stream(spark, landing, max_files=1)

    assert BatchRun(stream(), handle, checkpoint, max_batches=2).wait() == 2
    assert BatchRun(stream(), handle, checkpoint).wait() == 2
    assert seen == [(0, 2), (1, 2), (2, 2), (3, 2)]


def test_time_limit_ends_the_run(spark):
    landing = staged(spark, 1)
    run = BatchRun(
        feed.text_stream(spark, landing), lambda b, k: True, new_folder(spark, "checkpoint"),
        trigger={"processingTime": "100 milliseconds"},
    )
    run.wait(timeout=3)
    assert not run.query.isActive


def test_failures_are_raised(spark):
    def fail(batch, batch_id):
        raise RuntimeError("broken")

    with pytest.raises(Exception, match="broken"):
        BatchRun(feed.text_stream(spark, staged(spark, 1)), fail, new_folder(spark, "checkpoint")).wait()


def test_a_failure_after_the_limit_is_raised(spark):
    """Only the refusal of the next batch may be passed over."""
    landing = staged(spark, 2)

    def handle(batch, batch_id):
        run_holder[0].batches = 1
        raise RuntimeError("broken")

    run_holder = []
    run_holder.append(BatchRun(feed.text_stream(spark, landing), lambda b, k: handle(b, k), new_folder(spark, "checkpoint"), max_batches=1))
    with pytest.raises(Exception, match="broken"):
        run_holder[0].wait()


def test_running_counts_survive_a_restart(spark):
    landing, out, checkpoint = staged(spark, 1), new_folder(spark, "counts"), new_folder(spark, "checkpoint")

    def start():
        keys = keyed_counts.keyed_lines(feed.text_stream(spark, landing))
        return keyed_counts.start_running_counts(keys, out, checkpoint)

    start().wait()
    more = spark.createDataFrame([("a;9",), ("c",)], "value string")
    more.write.mode("append").text(landing)
    start().wait()
    totals = keyed_counts.read_counts(spark, out, "total")
    assert table(totals.select("batch_id", "key", "total")) == [
        "(0, 'a', 1)", "(0, 'b', 1)", "(1, 'a', 2)", "(1, 'b', 1)", "(1, 'c', 1)",
    ]


def test_changed_keys_only(spark):
    landing, out, checkpoint = staged(spark, 1), new_folder(spark, "counts"), new_folder(spark, "checkpoint")

    def start():
        keys = keyed_counts.keyed_lines(feed.text_stream(spark, landing))
        return keyed_counts.start_running_counts(keys, out, checkpoint, emit="changed")

    start().wait()
    spark.createDataFrame([("a;9",)], "value string").write.mode("append").text(landing)
    start().wait()
    last = keyed_counts.read_counts(spark, out, "total").where("batch_id = 1")
    assert table(last.select("key", "total")) == ["('a', 2)"]


def test_csv_stream_with_header(spark):
    landing = new_folder(spark, "feed")
    rows = spark.createDataFrame([("1", "en"), ("2", "fr")], "ID string, language string")
    full = rows.select([F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                        for f in feed.TWEET_SCHEMA])
    full.coalesce(1).write.option("sep", ";").option("header", True).csv(landing)
    seen = []
    BatchRun(
        feed.csv_stream(spark, landing, header=True),
        lambda b, k: seen.extend(tuple(r)[:2] for r in b.collect()) or True,
        new_folder(spark, "checkpoint"),
    ).wait()
    assert sorted(seen) == [("1", "en"), ("2", "fr")]


def test_preview_reads_every_batch(spark):
    stream = feed.text_stream(spark, staged(spark, 1))
    query = start_preview(stream, new_folder(spark, "checkpoint"), rows=1)
    query.awaitTermination()
    assert query.exception() is None
    assert query.lastProgress.numInputRows == 2


def test_old_model_versions_are_pruned(spark, records):
    root = new_folder(spark, "models")
    trainer = StreamTrainer(spark, root, WIDTH, ("LR", "MNB"), labels=LABELS, keep_versions=2)
    for k in range(4):
        trainer.process(records, k)
    assert {k for k, _, _ in states_of(trainer.store)} == {2, 3}
    assert trainer.store.latest(None, "state") == 3 and "LR" in trainer.store.load_states()
    assert trainer.metrics().select("batch_id").distinct().count() == 4
    again = StreamTrainer(spark, root, WIDTH, ("LR", "MNB"), labels=LABELS)
    again.process(records, 4)
    np.testing.assert_array_equal(again.store.load_states()["MNB"]["n0"][-1], 30)


def test_incomplete_batch_is_not_read(spark, records):
    root = new_folder(spark, "models")
    trainer = StreamTrainer(spark, root, WIDTH, ("MNB",), labels=LABELS)
    trainer.process(records, 0)
    # the run dies after its models of batch 1 and before the metrics
    trainer.store.save_states(1, {"MNB": {name: np.full(WIDTH + 1, 99.0) for name in ("n0", "n1")}})
    for restarted in (trainer, StreamTrainer(spark, root, WIDTH, ("MNB",), labels=LABELS)):
        np.testing.assert_array_equal(restarted.store.load_states(1)["MNB"]["n0"][-1], 6)
        np.testing.assert_array_equal(restarted.store.load_states(2)["MNB"]["n0"][-1], 6)
    restarted.process(records, 1)
    np.testing.assert_array_equal(restarted.store.load_states()["MNB"]["n0"][-1], 12)


class Crash(Exception):
    pass


@pytest.mark.parametrize("at", [None, "write_text", "delete"])
def test_metrics_are_compacted_and_survive_a_crash(spark, records, monkeypatch, at):
    root = new_folder(spark, "models")
    trainer = StreamTrainer(spark, root, WIDTH, ("MNB",), labels=LABELS)
    for k in range(4):
        trainer.process(records, k)
    want, store = metrics_of(trainer), trainer.store
    if at is not None:
        # The run ends between the table and the pointer, or between the pointer and the clearing up.
        def crash(*_):
            raise Crash

        with monkeypatch.context() as patch, pytest.raises(Crash):
            patch.setattr(f"brooktext.streaming.store.{at}", crash)
            store.compact()
        assert table(ModelStore(spark, root).metrics().drop("batch_time")) == want
    store = ModelStore(spark, root)
    assert store.compact() == 2 and store.compact() is None
    assert store._batches("metrics") == [3]
    assert table(store.metrics().drop("batch_time")) == want
    assert table(store.metrics().groupBy("batch_id").count()) == [f"({k}, 1)" for k in range(4)]
    # A gathered batch that is run again counts once; further batches find all versions complete.
    again = StreamTrainer(spark, root, WIDTH, ("MNB",), labels=LABELS, compact_every=2)
    again.process(records, 2)
    assert metrics_of(again) == want
    again.process(records, 4)
    again.process(records, 5)
    assert again.store._batches("metrics") == [5]
    assert ModelStore(spark, root).latest(None, "state") == 5 and again.metrics().count() == 6
