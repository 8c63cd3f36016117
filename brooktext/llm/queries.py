"""The registered queries of this folder: ``opN_<name>`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooktext.llm.contamination import contaminated
from brooktext.llm.language import identify_languages
from brooktext.llm.lines import dedup_lines
from brooktext.llm.mixing import mix_sources
from brooktext.llm.neardup import near_duplicates
from brooktext.llm.negatives import mine_negatives
from brooktext.llm.quality import judge_quality
from brooktext.llm.secrets import find_secrets, spans_text
from brooktext.llm.substring import remove_repeats
from brooktext.llm.suffixes import remove_repeated_bytes
from brooktext.llm.tokens import token_counts
from brooktext.llm.transcripts import format_chats
from brooktext.llm.vectors import integer_vectors
from brooktext.llm.whitening import whiten_embeddings
from brooktext.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(read_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read_table(spark, sf_dir, "documents")).drop("shares")


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read_table(spark, sf_dir, "documents"))

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in ("assign", "access", "hex")]
    digest = F.sha2(spans_text(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, spans_text(F.concat("base", "added")).alias("spans"))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents"))


@query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), width=2)


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The SQL has shingles at the starts of words only.
    kept = dedup_lines(read_table(spark, sf_dir, "documents"), starts_only=True)
    digest = F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_removed", digest)


@query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(read_table(spark, sf_dir, "conversations"))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(read_table(spark, sf_dir, "documents"))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_embeddings(integer_vectors(read_table(spark, sf_dir, "embeddings"), "embedding", "vec_id"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    return mine_negatives(integer_vectors(table, "embedding", "vec_id", label), F.col("vec_id") % 50 == 0)


@query
def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeated_bytes(read_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
