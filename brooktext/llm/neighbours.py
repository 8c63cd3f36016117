"""Components of similar rows from shared keys, without all pairs of a group.

Rows that share a key are candidates. A key that a third of all rows share
must not make all their pairs, and need not: only components are asked for.
So each round a few rows of every key are hubs, picked by hashes, and every row
of another component is checked against one hub for each of these picks, a
number of checks in proportion to the rows; links found merge components, and a key whose rows are
all in one component is done. Hubs are mostly rows that meet others often, the middle of a group of variants, to which more
of the group is similar than to a row at its rim. What is left after the rounds are keys with rows
of several components; there all pairs across components that the filter lets
through are checked, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brooktext.llm.components import components
from brooktext.sources.workspace import discard, materialize

ROUNDS = 2
HUBS = 3

# Pairs (a, b) to those of them that are similar.
Verify = Callable[[DataFrame], DataFrame]


def _weights(keys: DataFrame) -> DataFrame:
    """``of, weight``: how often a row meets others in ``keys``; most for the rows in the middle of a large group."""
    return keys.groupBy(F.col("id").alias("of")).agg(F.sum("n").alias("weight"))


def _labelled(keys: DataFrame, labels: DataFrame | None, weights: DataFrame) -> DataFrame:
    weighed = keys.join(weights, F.col("id") == F.col("of")).select("key", "id", "weight")
    if labels is None:
        return weighed.withColumn("label", F.col("id"))
    known = labels.select(F.col("id").alias("of"), "component")
    return weighed.join(known, F.col("id") == F.col("of"), "left").select(
        "key", "id", "weight", F.coalesce("component", "id").alias("label")
    )


def _open_keys(labelled: DataFrame, turn: int = 0) -> DataFrame:
    """Keys whose rows are in several components, with one of their rows of large weight as hub, another each ``turn``."""
    chance = F.col("weight") * (1024 + F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(1024)))
    grouped = labelled.groupBy(F.col("key").alias("open_key")).agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.max(F.struct(chance.alias("chance"), "id", "label")).alias("hub")
    )
    return grouped.where("low != high").select("open_key", F.col("hub.label").alias("hub_label"), F.col("hub.id").alias("hub"))


def _one_hub_each(labelled: DataFrame, checked: DataFrame | None, turn: int) -> DataFrame:
    """One pair for each row outside the hub's component: the hub it shares most keys with, not checked before."""
    met = labelled.join(_open_keys(labelled, turn), F.col("key") == F.col("open_key")).where("label != hub_label")
    pairs = met.groupBy(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"), "id").agg(
        F.count("*").alias("shared")
    )
    if checked is not None:
        pairs = pairs.join(checked, ["a", "b"], "left_anti")
    best = pairs.groupBy("id").agg(F.max(F.struct("shared", -F.col("a"), "a", "b")).alias("best"))
    return best.select("best.a", "best.b").distinct()


def shared_keys(keys: DataFrame) -> DataFrame:
    """The rows of ``keys`` (``key, id``) whose key another row has too, and ``n``, how many have it; a staged table."""
    held = keys.withColumn("n", F.count("*").over(Window.partitionBy("key")))
    return materialize(held.where("n > 1").select("key", "id", "n"), "shared_keys")


def similar_components(
    keys: DataFrame, details: DataFrame, near: Callable[[str, str], Column], verify: Verify, rounds: int = ROUNDS
) -> DataFrame:
    """``id, component`` of every row that has a link; a staged table.

    ``keys``: ``key, id, n`` as ``shared_keys`` returns them. ``details``: ``id`` and what ``near(left, right)``
    needs, a condition on its columns behind the prefixes ``left`` and
    ``right`` that must hold for similar rows. ``verify`` returns the similar
    ones among pairs ``a, b``. More ``rounds`` leave fewer rows of large groups for the last comparison.
    """
    links, labels, checked = None, None, None
    used: list[DataFrame] = []
    weights = materialize(_weights(keys), "key_weights")
    rows = keys
    for turn in range(rounds):
        labelled = _labelled(rows, labels, weights)
        if labels is not None:
            # Keys whose rows are in one component are done.
            labelled = labelled.join(_open_keys(labelled).select("open_key"), F.col("key") == F.col("open_key"), "left_semi")
        labelled = materialize(labelled, "labelled_keys")
        picks = [_one_hub_each(labelled, checked, turn * HUBS + pick) for pick in range(HUBS)]
        pairs = materialize(reduce(DataFrame.union, picks).distinct(), "pairs")
        if rows is not keys:
            discard(rows)
        rows = labelled.select("key", "id")
        rows.staged_path = labelled.staged_path
        checked = pairs if checked is None else checked.union(pairs)
        found = materialize(verify(pairs), "links")
        used += [pairs, found]
        nothing = found.isEmpty()
        if labels is None or not nothing:
            links = found if links is None else links.union(found)
            if labels is not None:
                discard(labels)
            labels = components(links)
        if nothing:
            break

    # All remaining pairs across components, in keys that several components share. A pair is made once, at the
    # smallest of the keys that both rows have, whatever the number of these.
    labelled = _labelled(rows, labels, weights)
    held = labelled.join(_open_keys(labelled), F.col("key") == F.col("open_key")).groupBy("id", "label").agg(
        F.collect_set("key").alias("keys")
    )
    held = held.join(details.withColumnRenamed("id", "of"), F.col("id") == F.col("of")).drop("of")
    open_rows = materialize(held.withColumn("key", F.explode("keys")), "open_rows")
    # One side of a pair across components is outside the largest component of the key.
    largest = open_rows.groupBy(F.col("key").alias("of_key"), "label").agg(F.count("*").alias("n")).groupBy("of_key").agg(
        F.max(F.struct("n", "label"))["label"].alias("largest")
    )
    marked = open_rows.join(largest, F.col("key") == F.col("of_key")).withColumn("outside", F.col("label") != F.col("largest"))
    columns = [c for c in marked.columns if c not in ("key", "of_key", "largest")]
    left = marked.where("outside").select("key", *[F.col(c).alias(f"left_{c}") for c in columns])
    right = marked.select(F.col("key").alias("same_key"), *[F.col(c).alias(f"right_{c}") for c in columns])
    across = (F.col("key") == F.col("same_key")) & (F.col("left_label") != F.col("right_label"))
    once = ~F.col("right_outside") | (F.col("left_id") < F.col("right_id"))
    here = F.array_min(F.array_intersect("left_keys", "right_keys")) == F.col("key")
    ends = (F.least("left_id", "right_id").alias("a"), F.greatest("left_id", "right_id").alias("b"))
    pairs = left.join(right, across & once & near("left_", "right_") & here).select(*ends)
    pairs = materialize(pairs.join(checked, ["a", "b"], "left_anti"), "pairs")
    final = components(links.union(verify(pairs)))
    discard(open_rows, labels, pairs, weights, *used, *([] if rows is keys else [rows]))
    return final
