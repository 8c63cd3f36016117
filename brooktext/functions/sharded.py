"""Linear scores with the weights as a table, for widths beyond what a plan literal holds.

``linear`` puts a weight vector into the plan, which is best up to some ten
thousand slots. Here the weights stay a distributed table ``slot, weight``, made
from the slot sums without passing through the driver, which sees a few totals
only. Rows are unfolded to their non-zero slots, joined with the table on the
slot and summed by row again. A slot that most rows hold (a common word) makes a large
join partition, which adaptive execution splits; both sides are shuffled
unless Spark finds the table small enough to broadcast.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooktext.functions.linear import decide
from brooktext.operators import linear_sgd, naive_bayes

# A width at which a hash hardly ever gives two words one slot.
SHARDED_WIDTH = 1 << 20


def nb_weight_table(sums: DataFrame, width: int, alpha: float = naive_bayes.ALPHA) -> tuple[DataFrame, float]:
    """Weights of ``naive_bayes.nb_weights`` from the sums ``slot, n0, n1``, and that of a slot without a sum."""
    terms = F.col("slot") < width
    totals = sums.agg(
        F.sum(F.when(terms, F.col("n0"))).alias("t0"), F.sum(F.when(terms, F.col("n1"))).alias("t1")
    ).first()
    shift = math.log((totals.t0 or 0.0) + alpha * width) - math.log((totals.t1 or 0.0) + alpha * width)
    likelihood = F.ln(F.col("n1") + alpha) - F.ln(F.col("n0") + alpha) + shift
    # A class without rows has no chance: the logarithm of 0 is infinite here, and null in SQL.
    prior = F.when(F.col("n1") == 0, float("-inf")).when(F.col("n0") == 0, float("inf")).otherwise(F.ln("n1") - F.ln("n0"))
    return sums.select("slot", F.when(terms, likelihood).otherwise(prior).alias("weight")), shift


def sgd_weight_table(sums: DataFrame, n: int) -> tuple[DataFrame, float]:
    """Weights after one step of ``n`` rows from zero, from the sums ``slot, residual``."""
    rate = 1.0 / (linear_sgd.ALPHA * linear_sgd.step_offset())
    return sums.select("slot", (F.col("residual") * (-rate / max(n, 1))).alias("weight")), 0.0


def with_sharded_prediction(
    rows: DataFrame, weights: DataFrame, default: float, margin: str = "margin", prediction: str = "prediction", key: str = "row_id"
) -> DataFrame:
    """Like ``linear.with_prediction``, with a weight table. Rows of one ``key`` are the same text; null keys are left out.

    ``default`` is the weight of a slot that the table lacks.
    """
    each = rows.select(F.col(key).alias("of_row"), "terms").dropDuplicates(["of_row"])
    terms = each.select("of_row", F.inline_outer("terms"))
    theirs = weights.select(F.col("slot").alias("of_slot"), "weight")
    met = terms.join(theirs, F.col("slot") == F.col("of_slot"), "left")
    scored = met.groupBy("of_row").agg(F.sum(F.col("count") * F.coalesce("weight", F.lit(default))).alias(margin))
    return rows.join(scored, F.col(key) == F.col("of_row")).drop("of_row").withColumn(prediction, decide(margin))
