import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brooktext.functions import metrics as M
from brooktext.functions.labels import extend_labels, index_batches, label_index_per_batch, stable_index


def labelled(spark, rows):
    return spark.createDataFrame(rows, "batch_id bigint, sentiment string")


def test_index_by_frequency_then_alphabet(spark):
    df = labelled(spark, [(0, "4"), (0, "0"), (0, "4"), (1, "4"), (1, "0"), (1, "4"), (1, "0")])
    index = {(r.batch_id, r.sentiment): r.label for r in label_index_per_batch(df).collect()}
    assert index == {(0, "4"): 0.0, (0, "0"): 1.0, (1, "0"): 0.0, (1, "4"): 1.0}
    assert index_batches(df).count() == 7


def test_stable_mapping_keeps_known_labels(spark):
    first = labelled(spark, [(0, "4")])
    later = labelled(spark, [(1, "0"), (1, "0"), (1, "4"), (1, "junk")])
    known = extend_labels([], first)
    assert known == ["4"]
    known = extend_labels(known, later)
    assert known == ["4", "0"]
    assert extend_labels(known, labelled(spark, [(2, "junk")])) == ["4", "0"]
    labels = [r.label for r in later.select(stable_index(known).alias("label")).collect()]
    assert labels == [1.0, 1.0, 0.0, None]


def test_new_label_is_found_beside_frequent_known_ones(spark):
    rows = [(0, "4")] * 5 + [(0, "0")]
    assert extend_labels(["4"], labelled(spark, rows)) == ["4", "0"]


def scored(spark, pairs):
    return spark.createDataFrame([(0, float(y), float(p)) for y, p in pairs], "batch_id bigint, label double, p double")


def test_undefined_rates_are_zero(spark):
    row = M.with_rates(M.confusion(scored(spark, [(0, 0), (0, 0)]), {"M": "p"})).first()
    assert (row.n, row.tn, row.accuracy, row.precision, row.recall) == (2, 2, 1.0, 0.0, 0.0)


def test_cluster_ids_are_aligned_by_majority(spark):
    row = M.with_rates(M.confusion(scored(spark, [(0, 1), (0, 1), (1, 0), (1, 1)]), {"K": "p"})).first()
    assert (row.accuracy, row.aligned_accuracy) == (0.25, 0.75)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.booleans()), min_size=1, max_size=30))
def test_confusion_counts_every_row(spark, pairs):
    row = M.confusion(scored(spark, pairs), {"A": "p"}).first()
    want = {cell: 0 for cell in ("tn", "fp", "fn", "tp")}
    for y, p in pairs:
        want[("tp" if p else "fn") if y else ("fp" if p else "tn")] += 1
    assert row.asDict() == {"model": "A", "n": len(pairs), **want}


def test_mean_accuracy_and_the_literal_divisor(spark):
    df = spark.createDataFrame(
        [("A", 0, 1.0), ("A", 1, 0.5), ("B", 0, 0.25)], "model string, batch_id bigint, accuracy double"
    )
    plain = {r.model: r.mean_accuracy for r in M.mean_accuracy(df).collect()}
    literal = {r.model: r.mean_accuracy for r in M.mean_accuracy(df, literal_divisor=True).collect()}
    assert plain == {"A": 0.75, "B": 0.25}
    assert literal == {"A": 0.5, "B": 0.125}
    assert [r.model for r in M.leaderboard(df).collect()] == ["A", "B"]
    assert M.batch_counter(df).first().batches == 2


def test_models_are_counted_in_one_aggregation(spark):
    df = scored(spark, [(0, 1)]).withColumn("q", F.lit(0.0))
    plan = M.confusion(df, {"A": "p", "B": "q"}, "batch_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    rows = {r.model: (r.fp, r.tn) for r in M.confusion(df, {"A": "p", "B": "q"}).collect()}
    assert rows == {"A": (1, 0), "B": (0, 1)}


def test_unknown_loss_is_refused():
    from brooktext.operators.linear_sgd import residual

    with pytest.raises(ValueError):
        residual(F.lit(0.0), "squared")
