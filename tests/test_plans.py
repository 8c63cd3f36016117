"""What the plans must not do, whatever the data size."""

import pytest

import __spark_entry__ as contract
from brooktext.plans import queries
from brooktext.sources import arrivals, tables

SF_DIR = "/root/testdata/sf0.001"
LAZY = [
    "wire_parse", "wire_split_literal", "header_filter", "null_drop", "dead_letter", "prefix_drop", "split_first",
    "first_field_key", "row_concat", "string_operations", "tokenize", "token_count", "hashing_tf_300", "densify",
    "features_and_label", "label_frequency", "label_index_per_batch", "label_index_stable", "batch_key_count",
    "preview_topn", "preview_counts", "nb_counts", "nb_predict", "sgd_gradient", "sgd_predict", "kmeans_predict",
    "confusion_matrix", "batch_metrics", "mean_accuracy", "score_all",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python_in_the_plan(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert operator not in plan


def test_texts_are_hashed_once(spark):
    for name in ("nb_counts", "hashing_tf_300", "token_count"):
        plan = plan_of(contract.queries()[name](spark, SF_DIR))
        assert plan.count("split(lower(") == 1, name


def test_counting_reads_only_its_columns(spark):
    plan = plan_of(contract.queries()["batch_key_count"](spark, SF_DIR))
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_label_queries_read_no_text(spark):
    plan = plan_of(contract.queries()["label_index_per_batch"](spark, SF_DIR))
    assert "text" not in plan


def test_an_arrival_reads_its_id_range_only(spark):
    bounds = arrivals.id_ranges(tables.read_table(spark, SF_DIR, "documents"), "doc_id")
    assert bounds == [(0, 50), (50, 100), (100, 150), (150, 200)]
    rows = tables.records(spark, SF_DIR).where(arrivals.in_range("row_id", bounds[1]))
    plan = plan_of(rows)
    assert plan.count("GreaterThanOrEqual(doc_id,50)") == 2 and plan.count("LessThan(doc_id,100)") == 2


def test_texts_are_dealt_out_only_if_the_session_says_so(spark):
    assert "RoundRobin" in plan_of(queries._texts(spark, SF_DIR))
    told = spark.conf.get(tables.SPREAD_SETTING)
    spark.conf.unset(tables.SPREAD_SETTING)
    try:
        for name in LAZY:
            assert "RoundRobin" not in plan_of(contract.queries()[name](spark, SF_DIR)), name
    finally:
        spark.conf.set(tables.SPREAD_SETTING, told)


def test_labels_beyond_the_broadcast_limit_are_shuffled(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = tables.records(spark, SF_DIR)
        assert "Broadcast" not in plan_of(rows)
        assert rows.count() == 87
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_no_text_is_moved_to_meet_the_labels(spark):
    """With broadcasting off, both sides of the join are shuffled: the documents as counts."""
    before, told = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get(tables.SPREAD_SETTING)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.unset(tables.SPREAD_SETTING)
    try:
        rows = tables.hashed_records(spark, SF_DIR, 300)
        plan = plan_of(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set(tables.SPREAD_SETTING, told)
    assert "SortMergeJoin" in plan
    exchanges = []

    def walk(node):
        if node.nodeName() == "Exchange":
            exchanges.append({node.output().apply(i).name() for i in range(node.output().size())})
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    prepared = rows._jdf.queryExecution().executedPlan()
    walk(prepared.initialPlan() if prepared.nodeName() == "AdaptiveSparkPlan" else prepared)
    assert sorted(map(sorted, exchanges)) == [["doc_id", "features"], ["doc_id", "quality"]]
