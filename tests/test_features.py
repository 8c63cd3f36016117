from pyspark.sql import functions as F

from brooktext.functions.features import feature_pipeline, hash_features, long_counts, with_terms

# Known buckets at width 300.
BUCKETS = {
    "a": 67, "ab": 119, "abc": 276, "abcd": 100, "hello": 189, "sentiment": 259,
    "spam12": 114, "_x": 7, "received": 201,
}


def test_known_buckets(spark):
    df = spark.createDataFrame([(i, term) for i, term in enumerate(BUCKETS)], "row_id bigint, message string")
    counts = long_counts(hash_features(df, 300), "row_id").orderBy("row_id").collect()
    assert [(r.bucket, r.tf) for r in counts] == [(bucket, 1) for bucket in BUCKETS.values()]


def test_pipeline_gives_the_same_features(spark, records):
    fitted = feature_pipeline(300).fit(records).transform(records)
    hashed = hash_features(records, 300).withColumnRenamed("features", "hashed")
    both = fitted.select("row_id", "features", "label").join(hashed, "row_id").collect()
    assert len(both) == records.count()
    assert all(row.features == row.hashed for row in both)
    assert {(row.sentiment, row.label) for row in both} == {("4", 0.0), ("0", 1.0)}


def test_rows_without_tokens_keep_a_bias_entry(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "..."), (4, "a a")], "row_id bigint, message string")
    rows = with_terms(hash_features(df, 300), 300).orderBy("row_id").select("terms").collect()
    assert [[tuple(term) for term in r.terms] for r in rows] == [[(300, 1.0)]] * 3 + [[(67, 2.0), (300, 1.0)]]


def test_features_need_no_shuffle(spark, records):
    plan = with_terms(hash_features(records, 300), 300).agg(F.count("terms"))
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
