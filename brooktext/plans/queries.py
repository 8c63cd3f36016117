"""Named queries over the given tables, one per operator.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brooktext.functions import metrics as M
from brooktext.functions.features import (
    TRAIN_WIDTH,
    WIDE_WIDTH,
    feature_pipeline,
    hash_features,
    long_counts,
    with_terms,
)
from brooktext.functions.labels import extend_labels, index_batches, label_frequency, stable_index
from brooktext.functions.linear import with_prediction
from brooktext.functions.sharded import SHARDED_WIDTH, nb_weight_table, sgd_weight_table, with_sharded_prediction
from brooktext.functions.text import field_at, prefix_drop, row_concat, split_first, tokenize
from brooktext.operators import kmeans, kmeans_many, linear_sgd, logistic, naive_bayes
from brooktext.operators.local_steps import local_updates
from brooktext.operators.sums import State, slot_sums
from brooktext.sources import arrivals, feed, row_offsets, tables, wire
from brooktext.sources.workspace import materialize, new_folder
from brooktext.streaming import keyed_counts, keyed_state
from brooktext.streaming.frames import mark_rejects
from brooktext.streaming.learners import (
    MODELS,
    ModelSet,
    score_metrics,
    stacked_predictions,
    update_linear,
    update_models,
    with_predictions,
)
from brooktext.streaming.lifecycle import BatchRun
from brooktext.streaming.progress import ProgressTable
from brooktext.streaming.scorer import StreamScorer
from brooktext.streaming.store import ModelStore
from brooktext.streaming.trainer import StreamTrainer

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
LINEAR_MODELS = ("SGD", "MNB", "KMEANS")
KMEANS_CENTRES = 5


def query(function: Query) -> Query:
    """Register under the function's name; a trailing underscore is not part of it."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


# --- sources -----------------------------------------------------------------


def _wire_arrivals(spark: SparkSession, sf_dir: str):
    """The labelled records as wire lines, one frame per arrival."""
    rows = tables.records(spark, sf_dir)
    ids = tables.read_table(spark, sf_dir, "documents")
    for bounds in arrivals.id_ranges(ids, "doc_id"):
        arrival = rows.where(arrivals.in_range("row_id", bounds))
        chunk = tables.id_batch("row_id", tables.RECORD_IDS_PER_BATCH)
        yield wire.to_wire(arrival.withColumn("chunk", chunk), "chunk").select("value")


def _event_arrivals(spark: SparkSession, sf_dir: str):
    """The events as ``;`` lines, the event type first."""
    events = tables.read_table(spark, sf_dir, "events")
    for bounds in arrivals.id_ranges(events, "event_id"):
        arrival = events.where(arrivals.in_range("event_id", bounds))
        yield arrival.select(F.concat_ws(";", "event_type", "event_id", "user_id").alias("value"))


def _land_text(path: str):
    return lambda arrival: arrival.write.mode("append").text(path)


@query
def text_stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per micro-batch of a streamed text folder."""
    landing, out, checkpoint = (new_folder(spark, p) for p in ("lines", "line-counts", "checkpoint"))

    def count_lines(batch: DataFrame, batch_id: int) -> bool:
        batch.agg(F.count(F.lit(1)).alias("n_lines")).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        return True

    arrivals.replay(
        _wire_arrivals(spark, sf_dir),
        _land_text(landing),
        lambda: BatchRun(feed.text_stream(spark, landing), count_lines, checkpoint),
    )
    return spark.read.schema("n_lines bigint, batch_id bigint").parquet(out)


@query
def csv_feed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream a delimited 14-column feed into a table."""
    landing, out, checkpoint = (new_folder(spark, p) for p in ("feed", "feed-rows", "checkpoint"))
    feed.to_feed(tables.read_table(spark, sf_dir, "events")).write.option("sep", ";").csv(landing)
    stream = feed.csv_stream(spark, landing)
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(feed.TWEET_SCHEMA).parquet(out).select("ID", "language", "Date", "Userid", "len", "followers")


def _read_once(batch: DataFrame, batch_id: int) -> bool:
    batch.write.format("noop").mode("overwrite").save()
    return True


@query
def rate_limited_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each micro-batch, 2,000 to a trigger, as the stream's progress tells them.

    The batches grow with the table, so each is kept cheap: the sink reads the rows inside the stream's own job, and the
    offsets are logged beside the batches, not between them.
    """
    state, out, checkpoint = (new_folder(spark, p) for p in ("row-offsets", "progress", "checkpoint"))
    events = feed.to_feed(tables.read_table(spark, sf_dir, "events"))
    staged = materialize(events, "feed", **{"parquet.block.row.count.limit": row_offsets.ROWS_PER_GROUP})
    stream = row_offsets.row_stream(spark, staged.staged_path, state, feed.FEED_ROWS, ["ID"])
    writer = stream.writeStream.format("noop").option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds")
    with ProgressTable(spark, out) as progress:
        run = writer.option("asyncProgressTrackingEnabled", True).start()
        try:
            run.processAllAvailable()
        finally:
            run.stop()
    return progress.table().select("batch_id", "n_rows")


@query
def batch_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each micro-batch of four arrivals and an empty one, from the progress table."""
    landing, out, checkpoint = (new_folder(spark, p) for p in ("lines", "progress", "checkpoint"))
    arriving = list(_event_arrivals(spark, sf_dir))
    arriving.insert(len(arriving) // 2, spark.createDataFrame([], "value string").repartition(1))
    with ProgressTable(spark, out) as progress:
        arrivals.replay(
            iter(arriving), _land_text(landing), lambda: BatchRun(feed.text_stream(spark, landing), _read_once, checkpoint)
        )
    return progress.table().select("batch_id", "n_rows")


# --- parsing -----------------------------------------------------------------


def _wire_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.records(spark, sf_dir)
    chunk = tables.id_batch("row_id", tables.RECORD_IDS_PER_BATCH)
    return wire.to_wire(rows.withColumn("batch_id", chunk), "batch_id")


@query
def wire_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode wire lines to records, without headers."""
    parsed = wire.parse_wire(_wire_lines(spark, sf_dir))
    good = wire.drop_headers(parsed.where(F.col("reject").isNull()))
    return good.select("batch_id", "sentiment", "message")


@query
def wire_parse_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire files read in byte ranges that end at records, decoded, without headers."""
    landing = new_folder(spark, "wire")
    _wire_lines(spark, sf_dir).select("value").write.text(landing)
    parsed = wire.parse_wire(wire.read_long_lines(spark, landing))
    return wire.drop_headers(parsed.where(F.col("reject").isNull())).select("sentiment", "message")


@query
def wire_split_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut wire lines as plain text, without headers."""
    return wire.drop_headers(wire.split_wire_literally(_wire_lines(spark, sf_dir)))


@query
def header_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per batch before and after the header filter."""
    parsed = wire.parse_wire(_wire_lines(spark, sf_dir))
    marked = parsed.select("batch_id", (F.col("sentiment") != wire.HEADER_LABEL).alias("kept"))
    return marked.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_all"), F.count_if("kept").alias("n_kept"))


@query
def null_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a label; those without one are dropped as NULL."""
    documents = tables.read_table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("message"))
    labels = tables.read_table(spark, sf_dir, "labels")
    joined = documents.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("row_id"), F.col("quality").cast("string").alias("sentiment"), "message"
    )
    return wire.drop_nulls(joined).select("row_id", "sentiment", F.length("message").alias("n_chars"))


@query
def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected records with the reason, from a feed where documents without a
    label arrive as bare text."""
    documents = tables.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = tables.read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    joined = documents.join(labels, "doc_id", "left")
    record = F.coalesce(F.concat(F.col("quality").cast("string"), F.lit(","), F.col("text")), "text")
    lines = joined.select("doc_id", F.to_json(F.array(F.concat(record, F.lit("\n")))).alias("value"))
    mapping = extend_labels([], tables.labelled_ids(spark, sf_dir))
    marked = mark_rejects(wire.parse_wire(lines), mapping)
    return marked.where(F.col("reject").isNotNull()).select("doc_id", "reject", "record")


@query
def prefix_drop_(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = tables.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return texts.select("doc_id", prefix_drop(F.col("text"), wire.RECORD_PREFIX).alias("rest"))


@query
def split_first_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at its first comma; NULL message without one."""
    sentiment, message = split_first(F.col("text"), ",")
    texts = tables.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return texts.select("doc_id", sentiment.alias("sentiment"), message.alias("message"))


@query
def first_field_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count by the first field of ``;`` lines."""
    lines = tables.read_table(spark, sf_dir, "events").select(
        F.concat_ws(";", "event_type", "event_id", "props").alias("line")
    )
    return keyed_counts.count_by_key(lines.select(field_at(F.col("line")).alias("key")))


@query
def row_concat_(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.read_table(spark, sf_dir, "events")
    time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return events.select("event_id", row_concat("event_id", "event_type", time, "user_id", "props").alias("line"))


@query
def string_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split, slice, concatenate and encode over whole texts."""
    texts = tables.read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return texts.select(
        "doc_id",
        F.size(F.split("text", "\n")).alias("n_lines"),
        F.concat_ws("", "lang", F.substring(F.col("text"), F.lit(3), F.length("text"))).alias("tag"),
        F.octet_length(F.encode("text", "UTF-8")).alias("n_bytes"),
    )


# --- features ----------------------------------------------------------------


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = tables.read_text_table(spark, sf_dir, "documents", "doc_id", "text")
    return texts.select(F.col("doc_id").alias("row_id"), F.col("text").alias("message"))


@query
def tokenize_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token list of every document, joined by blanks, and its length."""
    tokens = _texts(spark, sf_dir).select("row_id", tokenize(F.col("message")).alias("tokens"))
    return tokens.select(
        "row_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens")
    )


@query
def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of every token over all documents."""
    # explode_outer: a plain explode is preceded by a non-empty test, which tokenises once more
    tokens = _texts(spark, sf_dir).select(F.explode_outer(tokenize(F.col("message"))).alias("token"))
    tokens = tokens.where(F.col("token").isNotNull())
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query
def hashing_tf_300(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed term counts in long form, width 300."""
    return long_counts(hash_features(_texts(spark, sf_dir), TRAIN_WIDTH), "row_id")


@query
def hashing_tf_1000(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed term counts in long form, width 1,000."""
    return long_counts(hash_features(_texts(spark, sf_dir), WIDE_WIDTH), "row_id")


@query
def densify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense rows of the design matrix, as a distributed column."""
    hashed = hash_features(_texts(spark, sf_dir), TRAIN_WIDTH)
    dense = hashed.select("row_id", vector_to_array("features").alias("dense"))
    return dense.select(
        "row_id",
        F.size("dense").cast("bigint").alias("n_slots"),
        F.aggregate("dense", F.lit(0.0), lambda total, x: total + x).cast("bigint").alias("n_terms"),
    )


@query
def features_and_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokenizer, hasher and label index as one fitted ML pipeline."""
    rows = tables.records(spark, sf_dir)
    # The label index is the only stage that learns; it needs no text.
    fitted = feature_pipeline(TRAIN_WIDTH).fit(tables.labelled_ids(spark, sf_dir).withColumn("message", F.lit("")))
    features = fitted.transform(rows).select("row_id", "label", F.unwrap_udt("features").alias("v"))
    return features.select(
        "row_id",
        "label",
        F.size("v.indices").cast("bigint").alias("n_buckets"),
        F.aggregate("v.values", F.lit(0.0), lambda total, x: total + x).cast("bigint").alias("n_terms"),
    )


# --- labels and counts -------------------------------------------------------


@query
def label_frequency_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_frequency(tables.labelled_ids(spark, sf_dir), "batch_id")


@query
def label_index_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with the label index of its own batch."""
    return index_batches(tables.labelled_ids(spark, sf_dir)).select("row_id", "batch_id", "sentiment", "label")


@query
def label_index_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with the label index of one mapping for all batches."""
    rows = tables.labelled_ids(spark, sf_dir)
    mapping = extend_labels([], rows)
    return rows.select("row_id", "sentiment", stable_index(mapping).alias("label"))


@query
def batch_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_counts.count_by_key(tables.keyed_events(spark, sf_dir), "batch_id")


def _replay_events(spark: SparkSession, sf_dir: str, start, value: str) -> DataFrame:
    landing, out, checkpoint = (new_folder(spark, p) for p in ("lines", "counts", "checkpoint"))
    arrivals.replay(
        _event_arrivals(spark, sf_dir),
        _land_text(landing),
        lambda: start(keyed_counts.keyed_lines(feed.text_stream(spark, landing)), out, checkpoint),
    )
    return keyed_counts.read_counts(spark, out, value)


@query
def stream_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by key within each streamed micro-batch."""
    return _replay_events(spark, sf_dir, keyed_counts.start_batch_counts, "n")


@query
def running_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by key since the start, all keys at every micro-batch."""
    return _replay_events(spark, sf_dir, keyed_counts.start_running_counts, "total")


@query
def running_key_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number, sum and maximum by key since the start, kept by a given function; the keys of each micro-batch."""
    landing, out, checkpoint = (new_folder(spark, p) for p in ("events", "states", "checkpoint"))
    events = tables.read_table(spark, sf_dir, "events")
    parts = (events.where(arrivals.in_range("event_id", bounds)) for bounds in arrivals.id_ranges(events, "event_id"))
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.LongType())])

    def start() -> BatchRun:
        stream = spark.readStream.schema(schema).parquet(landing)
        states = keyed_state.running_state(stream, ["key"], keyed_state.sum_and_max, "n bigint, total bigint, most bigint")
        return keyed_state.start_running_state(states.drop("expired"), out, checkpoint)

    def land(arrival: DataFrame) -> None:
        rows = arrival.select(F.col("event_type").alias("key"), F.col("user_id").cast("bigint").alias("value"))
        rows.write.mode("append").parquet(landing)

    arrivals.replay(parts, land, start)
    return spark.read.schema("key string, n bigint, total bigint, most bigint, batch_id bigint").parquet(out)


@query
def preview_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five records, ordered to be reproducible."""
    rows = tables.records(spark, sf_dir)
    return rows.orderBy("row_id").limit(5)


@query
def preview_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten key counts of all batches, in key order."""
    counts = keyed_counts.count_by_key(tables.keyed_events(spark, sf_dir), "batch_id")
    return counts.orderBy("batch_id", "key").limit(10)


# --- learning ----------------------------------------------------------------


def feature_table(spark: SparkSession, sf_dir: str, width: int = TRAIN_WIDTH) -> tuple[DataFrame, tuple[int, int]]:
    """Features of all labelled records, stored once, and the class sizes.

    Learners pass over the rows several times. They read the stored counts, about
    a tenth of the text, and neither join nor tokenise again.
    """
    ids = tables.labelled_ids(spark, sf_dir)
    mapping = extend_labels([], ids)
    rows = tables.hashed_records(spark, sf_dir, width).withColumn("label", stable_index(mapping))
    stored = materialize(rows.drop("sentiment"), "features")
    sizes = stored.agg(F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1"))
    n0, n1 = sizes.first()
    return with_terms(stored, width), (n0, n1)


@query
def nb_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term counts per slot and class; the last slot holds the class sizes."""
    mapping = extend_labels([], tables.labelled_ids(spark, sf_dir))
    rows = tables.hashed_records(spark, sf_dir, TRAIN_WIDTH).withColumn("label", stable_index(mapping))
    rows = with_terms(rows, TRAIN_WIDTH)
    sums = slot_sums(rows, naive_bayes.nb_coefficients())
    return sums.select("slot", F.col("n0").cast("bigint").alias("n0"), F.col("n1").cast("bigint").alias("n1"))


@query
def nb_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = feature_table(spark, sf_dir)
    state = update_linear(rows, {}, ("MNB",), TRAIN_WIDTH, "log")["MNB"]
    scored = with_prediction(rows, naive_bayes.nb_weights(state), "log_odds")
    return scored.select("row_id", "label", F.round("log_odds", 4).alias("log_odds"), "prediction")


@query
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive Bayes trained and scored on all records."""
    rows, _ = feature_table(spark, sf_dir)
    state = update_linear(rows, {}, ("MNB",), TRAIN_WIDTH, "log")["MNB"]
    return score_metrics(rows, ModelSet({"MNB": state})).select(
        "model", "n", "tn", "fp", "fn", "tp", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall")]
    )


def _first_gradient(spark: SparkSession, sf_dir: str, width: int, loss: str) -> DataFrame:
    """One pass, so nothing is staged."""
    mapping = extend_labels([], tables.labelled_ids(spark, sf_dir))
    rows = tables.hashed_records(spark, sf_dir, width).withColumn("label", stable_index(mapping))
    rows = with_terms(rows, width)
    at_zero = rows.withColumn("sgd_margin", linear_sgd.sgd_margin(None))
    return slot_sums(at_zero, linear_sgd.sgd_coefficients(loss)).select("slot", F.col("residual").alias("gradient"))


@query
def sgd_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summed gradient of the log loss at zero weights."""
    return _first_gradient(spark, sf_dir, TRAIN_WIDTH, "log")


@query
def sgd_gradient_hinge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summed gradient of the hinge loss at zero weights, width 1,000."""
    return _first_gradient(spark, sf_dir, WIDE_WIDTH, "hinge")


@query
def sgd_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions after one step of the log loss."""
    rows, _ = feature_table(spark, sf_dir)
    state = update_linear(rows, {}, ("SGD",), TRAIN_WIDTH, "log")["SGD"]
    scored = with_prediction(rows, linear_sgd.sgd_weights(state), "margin")
    return scored.select("row_id", "label", F.round("margin", 4).alias("margin"), "prediction")


@query
def nb_predict_sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive Bayes over 2**20 slots, its weights a table joined by slot."""
    rows, _ = feature_table(spark, sf_dir, SHARDED_WIDTH)
    sums = materialize(slot_sums(rows, naive_bayes.nb_coefficients()), "slot_sums")
    scored = with_sharded_prediction(rows, *nb_weight_table(sums, SHARDED_WIDTH), "log_odds")
    return scored.select("row_id", "label", F.round("log_odds", 4).alias("log_odds"), "prediction")


@query
def sgd_predict_sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions after one step of the log loss over 2**20 slots, the weights a table joined by slot."""
    rows, sizes = feature_table(spark, sf_dir, SHARDED_WIDTH)
    at_zero = rows.withColumn("sgd_margin", linear_sgd.sgd_margin(None))
    sums = materialize(slot_sums(at_zero, linear_sgd.sgd_coefficients("log")), "slot_sums")
    scored = with_sharded_prediction(rows, *sgd_weight_table(sums, sum(sizes)))
    return scored.select("row_id", "label", F.round("margin", 4).alias("margin"), "prediction")


def _kmeans_after_one_step(rows: DataFrame) -> State:
    return update_linear(rows, {}, ("KMEANS",), TRAIN_WIDTH, "log")["KMEANS"]


@query
def kmeans_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both centres after one pass from the starting centres."""
    rows, _ = feature_table(spark, sf_dir)
    centre0, centre1 = kmeans.kmeans_centres(_kmeans_after_one_step(rows))
    centres = spark.createDataFrame(
        list(zip(range(TRAIN_WIDTH), centre0.tolist(), centre1.tolist(), strict=True)),
        "slot int, centre0 double, centre1 double",
    )
    return centres.select("slot", *[F.round(c, 6).alias(c) for c in ("centre0", "centre1")])


@query
def kmeans_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = feature_table(spark, sf_dir)
    weights = kmeans.kmeans_weights(_kmeans_after_one_step(rows))
    scored = with_prediction(rows, weights, "margin")
    return scored.select("row_id", "label", F.round("margin", 3).alias("margin"), "prediction")


@query
def kmeans_many_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five centres, started at the five records of lowest id, after one pass: sizes and sums of coordinates."""
    rows, _ = feature_table(spark, sf_dir)
    first = rows.orderBy("row_id").limit(KMEANS_CENTRES).select("row_id", vector_to_array("features").alias("v")).collect()
    start = np.array([row.v for row in first])
    state = {"start": start.ravel(), "sums": np.zeros(start.size), "counts": np.zeros(len(start))}
    state = kmeans_many.many_update(state, rows, TRAIN_WIDTH, KMEANS_CENTRES, reassign=False)
    cells = [
        (j, slot, int(n), float(value))
        for j, (n, centre) in enumerate(zip(state["counts"], kmeans_many.centres_of(state), strict=True))
        for slot, value in enumerate(centre)
    ]
    centres = spark.createDataFrame(cells, "centre int, slot int, n_rows bigint, value double")
    return centres.select("centre", "slot", "n_rows", F.round("value", 6).alias("value"))


@query
def lr_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes at the optimum of the logistic regression on all records."""
    rows, _ = feature_table(spark, sf_dir)
    scored = with_prediction(rows, logistic.lr_weights(logistic.lr_fit(rows, TRAIN_WIDTH)), "margin")
    return scored.select("row_id", "label", "prediction")


@query
def mlp_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = feature_table(spark, sf_dir)
    states = local_updates(rows, {}, ("MLP",), TRAIN_WIDTH, "log")
    predicted, columns = with_predictions(rows, ModelSet(states))
    return predicted.select("row_id", "label", F.col(columns["MLP"]).alias("prediction"))


@query
def lr_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validated r2 by iteration limit."""
    rows, _ = feature_table(spark, sf_dir)
    return spark.createDataFrame(logistic.lr_grid_search(rows, TRAIN_WIDTH), "max_iter int, r2 double")


# --- metrics over batches ----------------------------------------------------


def _batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The linear models, trained in one shared pass, scored per batch."""
    rows, _ = feature_table(spark, sf_dir)
    states = update_linear(rows, {}, LINEAR_MODELS, TRAIN_WIDTH, "log")
    batch = tables.id_batch("row_id", tables.RECORD_IDS_PER_BATCH)
    return score_metrics(rows.withColumn("batch_id", batch), ModelSet(states), "batch_id")


@query
def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = ("accuracy", "precision", "recall", "aligned_accuracy")
    return _batch_metrics(spark, sf_dir).select(
        "model", "batch_id", "n", "tn", "fp", "fn", "tp", *[F.round(c, 6).alias(c) for c in rates]
    )


@query
def mean_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean accuracy over the batches, and with the divisor one too large."""
    means = M.mean_accuracy(_batch_metrics(spark, sf_dir))
    literal = F.col("mean_accuracy") * F.col("batches") / (F.col("batches") + 1)
    return means.select(
        "model", "batches", F.round("mean_accuracy", 6).alias("mean_accuracy"), F.round(literal, 6).alias("literal_mean")
    )


@query
def accuracy_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    board = M.leaderboard(_batch_metrics(spark, sf_dir))
    return board.select("model", F.round("mean_accuracy", 6).alias("mean_accuracy"))


@query
def batch_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = tables.id_batch("row_id", tables.RECORD_IDS_PER_BATCH)
    rows, _ = feature_table(spark, sf_dir)
    state = update_linear(rows, {}, ("MNB",), TRAIN_WIDTH, "log")
    return M.batch_counter(score_metrics(rows.withColumn("batch_id", batch), ModelSet(state), "batch_id"))


# --- streams of models -------------------------------------------------------


def train_stream(spark: SparkSession, sf_dir: str, **options) -> StreamTrainer:
    """Train over the labelled records as a stream of four arrivals."""
    landing, root, checkpoint = (new_folder(spark, p) for p in ("wire", "models", "checkpoint"))
    labels = extend_labels([], tables.labelled_ids(spark, sf_dir))
    trainer = StreamTrainer(spark, root, labels=labels, **options)
    arrivals.replay(
        _wire_arrivals(spark, sf_dir),
        _land_text(landing),
        lambda: trainer.start(feed.text_stream(spark, landing), checkpoint),
    )
    return trainer


def _stream_metrics(trainer: StreamTrainer) -> DataFrame:
    rates = ("accuracy", "precision", "recall")
    return trainer.metrics().select(
        "model", "batch_id", "n", "tn", "fp", "fn", "tp", *[F.round(c, 6).alias(c) for c in rates]
    )


@query
def train_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive Bayes over the stream, width 1,000: metrics per batch."""
    return _stream_metrics(train_stream(spark, sf_dir, width=WIDE_WIDTH, models=("MNB",)))


@query
def train_nb_prequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive Bayes over the stream, each batch scored before it is learnt."""
    return _stream_metrics(train_stream(spark, sf_dir, models=("MNB",), mode="pre_fit"))


@query
def train_sgd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear classifier with hinge loss over the stream, width 1,000."""
    return _stream_metrics(train_stream(spark, sf_dir, width=WIDE_WIDTH, models=("SGD",), loss="hinge", passes=None))


@query
def train_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-means over the stream, width 1,000: metrics per batch."""
    return _stream_metrics(train_stream(spark, sf_dir, width=WIDE_WIDTH, models=("KMEANS",)))


@query
def train_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression refitted on each batch of the stream."""
    return _stream_metrics(train_stream(spark, sf_dir, models=("LR",)))


@query
def train_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multilayer perceptron carried over the batches of the stream."""
    return _stream_metrics(train_stream(spark, sf_dir, models=("MLP",)))


@query
def train_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five models over the stream: metrics per model and batch."""
    return _stream_metrics(train_stream(spark, sf_dir))


@query
def score_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of all five models for every record."""
    rows, sizes = feature_table(spark, sf_dir)
    models, _ = update_models(rows, ModelSet(), sizes)
    return stacked_predictions(rows, models)


@query
def score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on the stream, then score it with the saved models: mean accuracy."""
    trainer = train_stream(spark, sf_dir, models=MODELS)
    landing, checkpoint = new_folder(spark, "wire"), new_folder(spark, "checkpoint")
    _wire_lines(spark, sf_dir).select("value").write.text(landing)
    scorer = StreamScorer(spark, trainer.store.root)
    scorer.start(feed.text_stream(spark, landing), checkpoint).wait()
    return scorer.leaderboard()


@query
def model_save_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records on which a model and its saved and reloaded copy disagree."""
    rows, sizes = feature_table(spark, sf_dir)
    models, fitted = update_models(rows, ModelSet(), sizes)
    root = new_folder(spark, "models")
    store = ModelStore(spark, root, TRAIN_WIDTH)
    store.save_states(0, models.states)
    store.save_metrics(0, score_metrics(rows, models).collect(), fitted)
    reader = ModelStore(spark, root)
    loaded = ModelSet(reader.load_states())
    both, before = with_predictions(rows, models, "saved")
    both, after = with_predictions(both, loaded, "loaded")
    pairs = [F.struct(F.lit(m).alias("model"), (F.col(before[m]) != F.col(after[m])).alias("differ")) for m in before]
    compared = both.select(F.inline(F.array(*pairs)))
    return compared.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count_if("differ").alias("n_different"))
