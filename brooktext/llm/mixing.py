"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Targets. The sources, by code point with null last, weigh 1, 2, 3 and again 1,
2, 3; all words are shared by weight. No target goes above ``MOST`` times its
source's words; what is left over is shared again by weight among the others.
That ends at one level ``v`` with targets ``min(most * words, v * weight)``,
which a running sum over the sources by ``words / weight`` finds directly.

Rates. Among all rates between 0 and ``MOST`` whose words meet the target of
each source, entropy balancing takes those of least relative entropy to 1.
Their convex dual has one multiplier for each source, as a document belongs to
one: the rate is ``min(most, exp(multiplier * size / mean size))``. Newton
steps, kept between bounds that close in, solve all sources at once; every
step is one aggregation of the table of distinct (source, size) pairs.

Copies. The expected copies of the sizes of a source, in order of size, are
rounded down as running sums, so the words taken differ from the target by at
most about one document; inside a size they are dealt to slots by hash and to
the documents of a slot in hash order. Last, single sizes give or take one
copy where that brings the words closer to the target.

Scale. The text is read once to count words. All that follows works on narrow
staged tables; the only rows of every document are (id, source, size, slot).
Windows see the sources, the distinct sizes of a source, the slots of a size,
or the documents of a slot, and the number of slots follows the number of
documents, so no source and no group of equal sizes meets in one task. Source
tables are joined by Spark's own choice of strategy, without hints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brooktext.sources.workspace import discard, materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
NEWTON_STEPS = 40
CLOSE = 1e-9
SLOT_ROWS = 4096
REPAIRS = 6


def word_sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size`` of every row; a null text has size 0."""
    text = F.col("text").cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))


def source_targets(sizes: DataFrame, most: float = MOST) -> DataFrame:
    """``source, source_size, docs, target`` of each source; ``sizes`` has ``source, size, n``."""
    total = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs")
    )
    # UTF-8 strings compare by code point; one row for each source, so one task is enough.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    weighed = total.withColumn("weight", F.element_at(cycle, (place % len(WEIGHTS) + 1).cast("int")))
    cap = (F.col("source_size") * most).cast("double")
    by_ratio = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("whole") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    leveled = (
        weighed.withColumn("cap", cap)
        .withColumn("whole", F.sum("source_size").over(everything).cast("double"))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("level", level)
        .withColumn("step", F.row_number().over(by_ratio))
    )
    # The first source in this order that stays below its cap sets the level of all after it.
    below = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("step", "level"))
    open_level = F.min(below).over(everything)["level"]
    target = F.least(F.col("cap"), F.coalesce(open_level, F.col("level")) * F.col("weight"))
    return leveled.select("source", "source_size", "docs", target.alias("target"), "cap")


def _same_source(left: DataFrame, right: DataFrame) -> Column:
    return left["source"].eqNullSafe(right["source"])


def _solve(sizes: DataFrame, targets: DataFrame, most: float) -> DataFrame:
    """``source, multiplier, mean`` that meet the targets, by Newton steps within closing bounds."""
    mean = F.col("source_size") / F.col("docs")
    state = targets.select(
        F.col("source").alias("of"),
        "target",
        F.when(mean > 0, mean).otherwise(1.0).alias("mean"),
        # At the cap all rates are the cap; a target of 0 means a source without words.
        ((F.col("target") >= F.col("cap")) | (F.col("target") <= 0)).alias("fixed"),
        F.lit(0.0).alias("multiplier"),
        F.lit(-1e6).alias("low"),
        F.lit(1e6).alias("high"),
    )
    state = materialize(state, "mix_state")
    for _ in range(NEWTON_STEPS):
        joined = sizes.join(state.where(~F.col("fixed")), sizes["source"].eqNullSafe(state["of"]))
        share = F.col("size") / F.col("mean")
        tilt = F.exp(F.least(F.col("multiplier") * share, F.lit(50.0)))
        words = F.col("n") * F.col("size")
        sums = joined.groupBy(F.col("of").alias("source")).agg(
            F.sum(words * F.least(tilt, F.lit(float(most)))).alias("value"),
            F.sum(F.when(tilt < most, words * tilt * share).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("value") - F.col("target")
        low = F.when(gap < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(gap >= 0, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.col("multiplier") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > low) & (newton < high)
        middle = F.when(low <= -1e6, F.least(F.col("multiplier"), F.lit(-0.5)) * 4).when(
            high >= 1e6, F.greatest(F.col("multiplier"), F.lit(0.5)) * 4
        ).otherwise((low + high) / 2)
        done = F.abs(gap) <= F.lit(CLOSE) * F.col("target")
        moved = state.join(sums, state["of"].eqNullSafe(sums["source"]), "left").select(
            "of",
            "target",
            "mean",
            (F.col("fixed") | F.coalesce(done, F.lit(True))).alias("fixed"),
            F.when(F.col("fixed") | F.coalesce(done, F.lit(True)), F.col("multiplier"))
            .when(inside, newton)
            .otherwise(middle)
            .alias("multiplier"),
            F.when(F.col("fixed"), F.col("low")).otherwise(low).alias("low"),
            F.when(F.col("fixed"), F.col("high")).otherwise(high).alias("high"),
        )
        before, state = state, materialize(moved, "mix_state")
        discard(before)
        if state.where(~F.col("fixed")).isEmpty():
            break
    return state


def _planned_copies(sizes: DataFrame, targets: DataFrame, state: DataFrame, most: float) -> DataFrame:
    """``source, size, n, copies``: whole copies of each size of each source, running sums rounded."""
    solved = state.select("of", "multiplier", "mean")
    rate = F.when(F.col("target") >= F.col("cap"), F.lit(float(most))).otherwise(
        F.least(F.exp(F.least(F.col("multiplier") * F.col("size") / F.col("mean"), F.lit(50.0))), F.lit(float(most)))
    )
    tilted = (
        sizes.join(targets.withColumnRenamed("source", "from_source"), F.col("source").eqNullSafe(F.col("from_source")))
        .join(solved, F.col("source").eqNullSafe(F.col("of")))
        .select("source", "size", "n", "target", (F.col("n") * rate).alias("expected"))
    )
    by_size = Window.partitionBy("source").orderBy("size")
    running = F.sum("expected").over(by_size.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rounded = F.floor(running + 0.5)
    copies = rounded - F.coalesce(F.lag(rounded).over(by_size), F.lit(0))
    limit = F.col("n") * int(most)
    return tilted.select("source", "size", "n", "target", F.greatest(F.lit(0), F.least(copies, limit)).cast("long").alias("copies"))


def _repaired(cells: DataFrame, most: float) -> DataFrame:
    """One copy more or less of single sizes, where that brings a source closer to its target."""
    for _ in range(REPAIRS):
        by_source = Window.partitionBy("source")
        missing = F.col("target") - F.sum(F.col("copies") * F.col("size")).over(by_source)
        up = F.when(F.col("copies") < F.col("n") * int(most), F.abs(missing - F.col("size")))
        down = F.when(F.col("copies") > 0, F.abs(missing + F.col("size")))
        option = F.when(missing > 0, up).otherwise(down)
        tried = cells.withColumn("gap", F.abs(missing)).withColumn("sign", F.signum(missing)).withColumn("after", option)
        order = Window.partitionBy("source").orderBy(F.col("after").asc_nulls_last(), "size")
        first = F.row_number().over(order) == 1
        change = F.when(first & (F.col("after") < F.col("gap")), F.col("sign")).otherwise(0).cast("long")
        cells = tried.withColumn("copies", F.col("copies") + change).drop("gap", "sign", "after")
    return cells


def mix_sources(docs: DataFrame, most: int = MOST) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` of every row of ``docs``.

    ``size`` is the number of words, ``taken`` is ``copies * size``, ``target``
    is that of the document's source. ``docs`` needs ``doc_id, text, source``;
    other columns are not read. A null text has size 0 and gets one copy, as
    all texts without words do; a null source is a source of its own, last in
    order; rows of null ``doc_id`` and repeated rows are mixed like any others
    (each row gets its own copies); ties of the hash are broken by ``doc_id``,
    and rows alike in both may swap copies; no rows give no rows. A rerun over
    the same rows takes the same copies.
    """
    rows = word_sizes(docs)
    narrow = materialize(rows.withColumn("spread", F.xxhash64("doc_id")), "mix_sizes")
    sizes = materialize(narrow.groupBy("source", "size").agg(F.count("*").alias("n")), "mix_cells")
    targets = materialize(source_targets(sizes, most), "mix_targets")
    state = _solve(sizes, targets, most)
    cells = materialize(_repaired(_planned_copies(sizes.where("size > 0"), targets, state, most), most), "mix_copies")
    discard(state)

    # Slots: a group of equal size and source is dealt out so that no slot holds many rows.
    slots = F.pmod(F.col("spread"), F.floor(F.col("n") / SLOT_ROWS) + 1)
    own = sizes.select(F.col("source").alias("s"), F.col("size").alias("z"), "n")
    slotted = narrow.join(own, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).select(
        "doc_id", "source", "size", "spread", slots.alias("slot")
    )
    slotted = materialize(slotted, "mix_slots")
    held = slotted.groupBy("source", "size", "slot").agg(F.count("*").alias("held"))
    whole = cells.select(F.col("source").alias("s"), F.col("size").alias("z"), "n", "copies")
    planned = held.join(whole, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).drop("s", "z")
    by_slot = Window.partitionBy("source", "size").orderBy("slot")
    upto = F.sum("held").over(by_slot.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    due = F.floor(upto * F.col("copies") / F.col("n"))
    planned = planned.withColumn("due", due).withColumn(
        "slot_copies", F.col("due") - F.coalesce(F.lag("due").over(by_slot), F.lit(0))
    )
    planned = planned.select(
        F.col("source").alias("s"), F.col("size").alias("z"), F.col("slot").alias("t"), "held", "slot_copies"
    )
    inside = Window.partitionBy("source", "size", "slot").orderBy("spread", "doc_id")
    dealt = slotted.withColumn("rank", F.row_number().over(inside))
    base = F.floor(F.col("slot_copies") / F.col("held"))
    copies = base + F.when(F.col("rank") <= F.col("slot_copies") - base * F.col("held"), 1).otherwise(0)
    joined = dealt.join(
        planned,
        F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("slot") == F.col("t")),
        "left",
    ).drop("s", "z", "t")
    about = targets.select(F.col("source").alias("s"), "source_size", "target")
    return joined.join(about, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce(copies * F.col("size"), F.lit(0)).cast("long").alias("taken"),
        F.coalesce(copies, F.lit(1)).cast("long").alias("copies"),
    )
