"""Term-count features by feature hashing.

A feature frame has the hashed counts as an ML vector (``features``) for the
library's own learners and, derived from it, as an array ``terms`` of
``(slot, count)`` for expressions. The array ends with a bias entry (slot =
width, count = 1), so a message without tokens still has a row in every long
form and class sizes fall out of the same sums.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, RegexTokenizer, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooktext.functions.text import TOKEN_GAP, tokenize

# The two feature widths in use.
TRAIN_WIDTH = 300
WIDE_WIDTH = 1000


def hash_features(df: DataFrame, width: int, message: str = "message") -> DataFrame:
    """``df`` without its text, with the hashed term counts as ``features``."""
    hasher = HashingTF(inputCol="tokens", outputCol="features", numFeatures=width)
    tokens = df.withColumn("tokens", tokenize(F.coalesce(F.col(message), F.lit(""))))
    return hasher.transform(tokens).drop("tokens", message)


def slots() -> Column:
    return F.unwrap_udt(F.col("features"))["indices"]


def counts() -> Column:
    return F.unwrap_udt(F.col("features"))["values"]


def with_terms(df: DataFrame, width: int) -> DataFrame:
    """Add ``terms``, the non-zero counts with the bias entry at the end."""
    all_slots = F.concat(slots(), F.array(F.lit(width)))
    all_counts = F.concat(counts(), F.array(F.lit(1.0)))
    return df.withColumn("terms", F.arrays_zip(all_slots.alias("slot"), all_counts.alias("count")))


def with_norm(df: DataFrame) -> DataFrame:
    """Add ``row_norm``, the length of the count vector; 1 for a row without tokens."""
    length = F.sqrt(F.aggregate(counts(), F.lit(0.0), lambda total, x: total + x * x))
    return df.withColumn("row_norm", F.greatest(length, F.lit(1.0)))


def long_counts(df: DataFrame, *keep: str) -> DataFrame:
    """One row per non-zero count: ``keep..., bucket, tf``.

    Unfolded with NULLs kept and then dropped: for a plain ``inline`` the
    optimizer adds a non-empty test below, which would hash every text twice.
    """
    terms = F.arrays_zip(slots().alias("bucket"), counts().alias("value"))
    unfolded = df.select(*keep, F.inline_outer(terms)).where(F.col("bucket").isNotNull())
    return unfolded.select(*keep, "bucket", F.col("value").cast("bigint").alias("tf"))


def feature_pipeline(width: int) -> Pipeline:
    """The three stages as one ML pipeline, label index by frequency."""
    tokenizer = RegexTokenizer(inputCol="message", outputCol="tokens", pattern=TOKEN_GAP)
    hasher = HashingTF(inputCol="tokens", outputCol="features", numFeatures=width)
    indexer = StringIndexer(inputCol="sentiment", outputCol="label")
    return Pipeline(stages=[tokenizer, hasher, indexer])
