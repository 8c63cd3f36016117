"""Connected components of links, as a distributed union-find in DataFrame operations.

Every round hooks each component onto the smallest component it is linked
with, follows the hooks to their roots by pointer jumping, and contracts the
links to pairs of roots. Each round at least halves the number of components
that still have links, so the rounds grow with the logarithm of the size.
Hooks are grouped minima (combined before the shuffle) and joins on unique
keys, so a component with a very large number of links only makes a join side
that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooktext.sources.workspace import discard, materialize


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every id in ``links`` (``a, b``): the smallest id reachable.

    A staged table. Links may repeat and may be given either way round; no links give no rows.
    """
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    edges = materialize(pairs, "links")
    ends = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()
    labels = materialize(ends.select("id", F.col("id").alias("component")), "labels")
    while not edges.isEmpty():
        # Each larger root hooks onto the smallest root it is linked with.
        hooks = materialize(edges.groupBy(F.col("b").alias("root")).agg(F.min("a").alias("to")), "hooks")
        while True:
            further = hooks.select(F.col("root").alias("via"), F.col("to").alias("end"))
            jumped = hooks.join(further, F.col("to") == F.col("via"), "left").select(
                "root", F.coalesce("end", "to").alias("to"), F.col("end").isNotNull().alias("moved")
            )
            jumped = materialize(jumped, "hooks")
            discard(hooks)
            hooks = jumped.select("root", "to")
            hooks.staged_path = jumped.staged_path
            if jumped.where("moved").isEmpty():
                break
        labels, edges = _relabel(labels, edges, hooks)
    discard(edges)
    return labels


def _relabel(labels: DataFrame, edges: DataFrame, hooks: DataFrame) -> tuple[DataFrame, DataFrame]:
    moved = labels.join(hooks, F.col("component") == F.col("root"), "left").select(
        "id", F.coalesce("to", "component").alias("component")
    )
    left = hooks.select(F.col("root").alias("root_a"), F.col("to").alias("to_a"))
    right = hooks.select(F.col("root").alias("root_b"), F.col("to").alias("to_b"))
    ends = (
        edges.join(left, F.col("a") == F.col("root_a"), "left")
        .join(right, F.col("b") == F.col("root_b"), "left")
        .select(F.coalesce("to_a", "a").alias("x"), F.coalesce("to_b", "b").alias("y"))
    )
    contracted = ends.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    new_labels, new_edges = materialize(moved, "labels"), materialize(contracted, "links")
    discard(labels, edges, hooks)
    return new_labels, new_edges
