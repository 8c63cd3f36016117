"""The corpus pipeline: documents in, mixed training documents out.

Each stage works on all rows that the one before kept. Rows are told apart by
``doc_id``; a row of null ``doc_id`` is compared with none, so only the
language stage can drop it, and it is taken once by the mix. Extra columns are
passed on as they are; ``n_chars``, where present, follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooktext.llm.contamination import contaminated
from brooktext.llm.language import keep_identified
from brooktext.llm.lines import repeated_lines, without_lines
from brooktext.llm.mixing import mix_sources
from brooktext.llm.neardup import near_duplicates
from brooktext.sources.tables import read_table
from brooktext.sources.workspace import discard, materialize

LEAST_SCORE = 0.3
WORD = r"[^\x20\x09-\x0D]"


def _without(docs: DataFrame, ids: DataFrame, purpose: str) -> DataFrame:
    """``docs`` less the rows of ``ids``.

    The ids are staged first, so their size is known when the join is planned:
    few are broadcast, many are joined by a shuffle.
    """
    gone = materialize(ids.select(F.col("doc_id").alias("gone_doc")).distinct(), purpose)
    return docs.join(gone, docs["doc_id"] == gone["gone_doc"], "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no language: null texts, texts without a letter, texts that no language fits."""
    return keep_identified(docs, LEAST_SCORE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that an earlier line is like; a document that loses lines and has only blank ones left goes."""
    cut = without_lines(docs, repeated_lines(docs.select("doc_id", "text")))
    cut = cut.where((F.col("lines_gone") == 0) | F.col("text").rlike(WORD))
    chars = F.char_length("text")
    new = {"text": F.col("text"), "n_chars": chars.cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return cut.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group of near-duplicates."""
    judged = near_duplicates(docs)
    return _without(docs, judged.where(~F.col("kept")), "near_duplicates")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, edited or not."""
    return _without(docs, contaminated(docs, read_table(spark, sf_dir, "benchmark")), "contaminated")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``copies`` and the words ``taken``."""
    mixed = mix_sources(docs).where("doc_id IS NOT NULL")
    mixed = materialize(mixed.select(F.col("doc_id").alias("mixed_doc"), "copies", "taken"), "mix")
    once = mixed.dropDuplicates(["mixed_doc"])
    joined = docs.join(once, docs["doc_id"] == once["mixed_doc"], "left")
    copies = F.coalesce(once["copies"], F.lit(1).cast("long"))
    taken = F.coalesce(once["taken"], F.lit(0).cast("long"))
    given = [docs[c] for c in docs.columns if c not in ("mix_copies", "mix_taken")]
    return joined.where(copies > 0).select(*given, copies.alias("mix_copies"), taken.alias("mix_taken"))


STAGES = [
    ("language id", language_id),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mix", mix),
]
# No SQL can learn a language model or iterate to a mix; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    staged: list[DataFrame] = []
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        discard(*staged)
        staged = [docs]
    return docs
