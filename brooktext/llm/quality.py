"""Quality rules: robust multivariate outliers by language and source, in DataFrame operations only.

Five counts of each text make a vector of transformed statistics: log words,
log mean word length, and log rates of symbols, repeated lines and repeated
words. For each language and source a minimum-covariance-determinant estimate
is fitted to the texts that pass the base rules: from a start by medians and
median deviations, concentration steps re-estimate mean and covariance from
the three quarters of the rows that are closest, which never raises the
determinant; a last step uses all rows within the 0.975 quantile. A text whose
squared Mahalanobis distance exceeds ``FARTHEST`` is rejected. Statistics that
hardly vary get a least spread, so a statistic that is 0 almost everywhere
rejects large values only.

Sources of fewer than ``MIN_ROWS`` texts in a language are pooled by language;
pools below that have no estimate and reject nothing beyond the base rules.

Scale: one pass over the texts leaves a narrow staged table; every step is a
grouped aggregation of it (sums, or an approximate quantile that combines
before the shuffle), and the estimates, some 20 numbers a group, are joined
back by group, with large groups split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooktext.sources.workspace import discard, materialize

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
SHINGLE = 8
STATS = 5
# Least standard deviation of each statistic. A log rate is at most log(101) = 4.6, which squared and
# over the square of its spread must exceed FARTHEST, or the statistic alone rejects nothing.
SPREADS = (0.3, 0.05, 0.4, 0.3, 0.3)
HELD = 0.75
STEPS = 4
# Chi-square with 5 degrees of freedom: the 0.75 subset underestimates the
# covariance by 0.75 / P(chi2_7 <= 6.63); 12.83 is the 0.975 quantile; above
# FARTHEST lie 5 in 10 million rows of a normal group.
CONSISTENCY = 1.41
REWEIGHT = 12.83
REWEIGHT_CONSISTENCY = 1.06
FARTHEST = 38.0
MIN_ROWS = 50


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column, width: int = SHINGLE) -> Column:
    """Words in windows of ``width`` words that the text holds twice or more."""

    def windows(hashes: Column) -> Column:
        last = F.size(hashes) - width
        return F.when(
            last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(hashes, i + 1, F.lit(width))))
        ).otherwise(F.array().cast("array<bigint>"))

    def covered(found: Column) -> Column:
        pairs = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        at = _let(pairs, lambda s: F.filter(F.transform(s, lambda e, k: _repeated(s, e, k)), lambda i: i.isNotNull()))
        return _let(F.sort_array(at), lambda p: F.aggregate(F.transform(p, lambda v, k: _new(p, v, k)), F.lit(0), lambda a, b: a + b))

    def _repeated(s: Column, e: Column, k: Column) -> Column:
        same = (F.get(s, k - 1)["h"] == e["h"]) | (F.get(s, k + 1)["h"] == e["h"])
        return F.when(F.coalesce(same, F.lit(False)), e["i"])

    def _new(p: Column, v: Column, k: Column) -> Column:
        return F.coalesce(F.least(F.lit(width), v - F.get(p, k - 1)), F.lit(width))

    def count(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(covered(found))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: _let(windows(hashes), count))


def text_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` and the counts of every row; a null text has no words."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD))
    counted = rows.select(
        "doc_id",
        "lang",
        "source",
        _let(words, lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("r"))).alias("w"),
        F.char_length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )
    n, repeated = F.col("w.n").cast("long"), F.col("w.r").cast("long")
    failed = (n < 20) | (repeated * 100 > n * 30)
    return counted.select(
        "doc_id", "lang", "source", n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        repeated.alias("n_repeat_words"), failed.alias("base_failed"),
    )


def _vector() -> list[Column]:
    rate = [F.log1p(F.col(c) * 100.0 / F.col("n_words")) for c in ("n_symbols", "n_dup_lines", "n_repeat_words")]
    values = [F.log("n_words"), F.log(F.col("word_chars") / F.col("n_words")), *rate]
    return [value.alias(f"x{k}") for k, value in enumerate(values)]


def _grouped(stats: DataFrame) -> DataFrame:
    """Rows that pass the base rules with their vector and the number ``of`` their group: language and source, or pool."""
    good = stats.where(~F.col("base_failed")).select("row", "lang", "source", *_vector())
    sizes = good.groupBy(F.col("lang").alias("l"), F.col("source").alias("s")).agg(F.count("*").alias("n"))
    same = F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s"))
    # 0: a source of its own; 1: no source; 2: the pool of its language.
    part = F.when(F.col("n") < MIN_ROWS, 2).when(F.col("source").isNull(), 1).otherwise(0)
    # One number for each group keeps the rows, and every aggregation and join over them, narrow.
    group = F.xxhash64("lang", F.col("lang").isNull(), part, F.when(part == 0, F.col("source")))
    return good.join(sizes, same).select("row", group.alias("of"), *[f"x{k}" for k in range(STATS)])


def _estimate(rows: DataFrame, factor: float) -> DataFrame:
    """``to, n``, means ``m*`` and the factors ``d*, l*_*`` of ``L D L'`` of the covariance of each group."""
    x = [F.col(f"x{k}") for k in range(STATS)]
    cross = [F.avg(x[i] * x[j]).alias(f"c{i}_{j}") for i in range(STATS) for j in range(i + 1)]
    out = rows.groupBy(F.col("of").alias("to")).agg(F.count("*").alias("n"), *[F.avg(v).alias(f"m{k}") for k, v in enumerate(x)], *cross)
    mean = [F.col(f"m{k}") for k in range(STATS)]
    cov = [
        ((F.col(f"c{i}_{j}") - mean[i] * mean[j]) * factor + (SPREADS[i] ** 2 if i == j else 0.0)).alias(f"c{i}_{j}")
        for i in range(STATS)
        for j in range(i + 1)
    ]
    out = out.select("to", "n", *[f"m{k}" for k in range(STATS)], *cov)
    for j in range(STATS):
        before = [F.col(f"l{j}_{k}") * F.col(f"l{j}_{k}") * F.col(f"d{k}") for k in range(j)]
        out = out.withColumn(f"d{j}", F.greatest(F.col(f"c{j}_{j}") - sum(before, F.lit(0.0)), F.lit(1e-9)))
        for i in range(j + 1, STATS):
            shared = [F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") * F.col(f"d{k}") for k in range(j)]
            out = out.withColumn(f"l{i}_{j}", (F.col(f"c{i}_{j}") - sum(shared, F.lit(0.0))) / F.col(f"d{j}"))
    return out.drop(*[f"c{i}_{j}" for i in range(STATS) for j in range(i + 1)])


def _distances(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance ``far`` from their group's estimate."""
    out = rows.join(estimate, F.col("of") == F.col("to"))
    for i in range(STATS):
        known = [F.col(f"l{i}_{j}") * F.col(f"z{j}") for j in range(i)]
        out = out.withColumn(f"z{i}", F.col(f"x{i}") - F.col(f"m{i}") - sum(known, F.lit(0.0)))
    far = sum((F.col(f"z{k}") * F.col(f"z{k}") / F.col(f"d{k}") for k in range(STATS)), F.lit(0.0))
    return out.select("row", "of", *[f"x{k}" for k in range(STATS)], "n", far.alias("far"))


def _start(rows: DataFrame) -> DataFrame:
    """Medians and median absolute deviations as a first, diagonal estimate."""

    def median(column: str | Column) -> Column:
        return F.percentile_approx(column, 0.5, 1000)

    centre = rows.groupBy(F.col("of").alias("to")).agg(F.count("*").alias("n"), *[median(f"x{k}").alias(f"m{k}") for k in range(STATS)])
    spread = rows.join(centre, F.col("of") == F.col("to")).groupBy("of").agg(
        *[median(F.abs(F.col(f"x{k}") - F.col(f"m{k}"))).alias(f"s{k}") for k in range(STATS)]
    )
    both = centre.join(spread, F.col("of") == F.col("to"))
    factors = [(F.pow(F.col(f"s{k}") * 1.4826, 2) + SPREADS[k] ** 2).alias(f"d{k}") for k in range(STATS)]
    lower = [F.lit(0.0).alias(f"l{i}_{j}") for i in range(STATS) for j in range(i)]
    return both.select("to", "n", *[f"m{k}" for k in range(STATS)], *factors, *lower)


def robust_estimates(rows: DataFrame) -> DataFrame:
    """The reweighted minimum-covariance-determinant estimate of each group; a staged table."""
    estimate = materialize(_start(rows), "mcd")
    for _ in range(STEPS):
        measured = _distances(rows, estimate)
        limit = measured.groupBy(F.col("of").alias("lim")).agg(F.percentile_approx("far", HELD, 1000).alias("limit"))
        closest = measured.join(limit, F.col("of") == F.col("lim")).where("far <= limit")
        before, estimate = estimate, materialize(_estimate(closest, CONSISTENCY), "mcd")
        discard(before)
    weighed = _distances(rows, estimate).where(F.col("far") <= REWEIGHT)
    final = materialize(_estimate(weighed, REWEIGHT_CONSISTENCY), "mcd")
    discard(estimate)
    return final


def judge_quality(docs: DataFrame, farthest: float = FARTHEST) -> DataFrame:
    """The counts of every row of ``docs``, ``base_failed``, the ``distance`` and ``kept``.

    ``docs`` needs ``doc_id, text, lang, source``; other columns are not read.
    A null or empty text has no words and fails the base rules. A null
    language or source is a value of its own. Rows of null ``doc_id`` and
    repeated rows are judged each; ties at a quantile are all taken in; no
    rows give no rows. ``distance`` is null where there is no estimate.
    """
    numbered = text_statistics(docs).withColumn("row", F.monotonically_increasing_id())
    stats = materialize(numbered, "text_stats")
    rows = materialize(_grouped(stats), "stat_vectors")
    estimates = robust_estimates(rows)
    far = _distances(rows, estimates.where(F.col("n") >= MIN_ROWS // 2)).select(F.col("row").alias("of_row"), F.col("far").alias("distance"))
    joined = stats.join(far, F.col("row") == F.col("of_row"), "left")
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= farthest)
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance"
    )
