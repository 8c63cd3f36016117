import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from brooktext.llm import negatives
from brooktext.llm.negatives import Tree, distances, flat, lifted, mine_negatives
from brooktext.llm.vectors import inner_products, integer_vectors
from brooktext.llm.whitening import centred, square_sums, whiten_embeddings

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id bigint, embedding array<double>, label int, x string, n int, i int, leaf string, qid string"


def table(spark, rows):
    return spark.createDataFrame([(*row, "clash", 1, 2, "l", None) for row in rows], SCHEMA)


def vectors(n, width, seed, spread=1.0):
    random = np.random.default_rng(seed)
    return (random.normal(size=(n, width)) * spread).round(4).tolist()


def odd(rows, width):
    return [
        *rows,
        (9001, None, 1),
        (9002, [1.0] * (width - 1) + [None], 1),
        (9003, [NAN] + [1.0] * (width - 1), 2),
        (9004, [INF] * width, 2),
        rows[0],
        rows[0],
        (9050, rows[0][1], rows[0][2]),
    ]


# --- 12 whitening -------------------------------------------------------------


def brute_whitening(rows, top=4):
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = {i: [int(np.floor(256 * c)) for c in v] for i, v in usable}
    fit = [list(v) for v in {tuple(v) for v in x.values()}]
    n, width = len(fit), len(fit[0])
    sums = [sum(v[d] for v in fit) for d in range(width)]
    exact = [[Fraction(sum((n * v[a] - sums[a]) * (n * v[b] - sums[b]) for v in fit), n**3) for b in range(width)] for a in range(width)]
    values, axes = np.linalg.eigh(np.array([[float(e) for e in row] for row in exact]))
    trace = float(sum(exact[d][d] for d in range(width)))
    out = {}
    for i, v in x.items():
        d = [n * v[k] - sums[k] for k in range(width)]
        for c in range(min(top, width)):
            e, axis = values[-1 - c], axes[:, -1 - c]
            out[i, c + 1] = (n, sum(k * k for k in d), float(np.dot([k / n for k in d], axis)) / np.sqrt(e), e / trace)
    return out


def test_whitening_against_exact_fractions(spark):
    rows = odd([(i, v, i % 3) for i, v in enumerate(vectors(60, 6, 1))], 6)
    got = whiten_embeddings(integer_vectors(table(spark, rows), "embedding", "vec_id")).collect()
    want = brute_whitening([row[:2] for row in rows])
    assert len(got) == 4 * (60 + 3) and {(r.vec_id, r.component) for r in got} == set(want)
    signs = {c: np.sign(next(r.whitened for r in got if (r.vec_id, r.component) == (5, c)) * want[5, c][2]) for c in range(1, 5)}
    for r in got:
        n, deviation, whitened, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation) and r.identity_error < 1e-9
        assert r.whitened * signs[r.component] == pytest.approx(whitened, abs=1e-9)
        assert r.explained == pytest.approx(explained, rel=1e-9)


def test_squares_of_large_values_are_exact():
    random = np.random.default_rng(3)
    values = random.integers(-(2**61), 2**61, size=(50, 3))
    assert square_sums(values) == [sum(int(v) ** 2 for v in values[:, k]) for k in range(3)]
    huge = centred(values, 1000, [1, 2, 3])
    assert square_sums(huge) == [sum((1000 * int(v) - k - 1) ** 2 for v in values[:, k]) for k in range(3)]


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(None, None, None)]])
def test_no_vectors_give_no_rows(spark, rows):
    given = integer_vectors(table(spark, rows), "embedding", "vec_id", F.col("label"))
    assert whiten_embeddings(given).collect() == []
    assert mine_negatives(given, F.lit(True)).collect() == []


def test_components_without_variance_are_zero(spark):
    one = whiten_embeddings(integer_vectors(table(spark, [(None, [0.5, 0.25], 1), (2, [0.5, 0.25], 1)]), "embedding", "vec_id")).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(one, key=lambda r: (r.vec_id or 0, r.component))] == [
        (v, c, 1, 0, 0.0, 0.0, 0.0) for v in (None, 2) for c in (1, 2)
    ]
    # All on one line: one component takes all of the variance. A shorter vector ends in zeros.
    line = [(k, [float(k), 2.0 * k, 0.0], 1) for k in range(9)] + [(20, [5.0, 10.0], 1)]
    flat_rows = whiten_embeddings(integer_vectors(table(spark, line), "embedding", "vec_id")).collect()
    assert all(r.whitened == 0 and r.explained < 1e-12 for r in flat_rows if r.component > 1)
    assert all(r.explained == pytest.approx(1) and r.n == 9 and r.identity_error < 1e-9 for r in flat_rows if r.component == 1)


# --- 13 hard negatives --------------------------------------------------------


def brute_negatives(rows, is_anchor):
    usable = {(i, label, tuple(int(np.floor(256 * c)) for c in v)) for i, v, label in rows if label is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)}
    out = []
    for a, la, xa in usable:
        if not is_anchor(a):
            continue
        scored = [(-sum(p * q for p, q in zip(xa, x, strict=True)), i, label) for i, label, x in usable]
        positives = sorted((s, i) for s, i, label in scored if label == la and i != a)[:5]
        for s, p in positives:
            window = sorted((t, i) for t, i, label in scored if label != la and 50 * -s <= 100 * -t <= 95 * -s)[:3]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i) in enumerate(window)]
    return sorted(out)


@pytest.mark.parametrize("leaf_rows", [8, 10_000])
def test_negatives_against_brute_force(spark, monkeypatch, leaf_rows):
    monkeypatch.setattr(negatives, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(negatives, "PACK", 3)
    centres = vectors(12, 3, 8, 2.0)
    rows = [(i, [c + e for c, e in zip(centres[i % 12], v, strict=True)], i % 4) for i, v in enumerate(vectors(220, 3, 9, 0.2))]
    rows += [(500 + i, rows[10][1], 10 % 4) for i in range(40)]  # a vector that many rows hold
    rows += [(600 + i, rows[10][1], 3) for i in range(20)]
    rows += [(700, rows[1][1], None), (800, [0.0, 0.0, 0.0], 1), (810, [-9.0, 0.0, 0.0], 77)]
    rows = odd(rows, 3)
    usable = integer_vectors(table(spark, rows), "embedding", "vec_id", "label")
    got = sorted(tuple(r) for r in mine_negatives(usable, F.col("vec_id") % 10 == 0).collect())
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert len(want) > 300
    assert got == want


def test_packs_are_met_by_a_shuffle_whatever_their_probes_weigh(spark, monkeypatch):
    """A probe is in a pack of each leaf that it visits: packs of few probes are no small table that the driver could hold."""
    monkeypatch.setattr(negatives, "LEAF_ROWS", 8)
    monkeypatch.setattr(negatives, "PACK", 3)
    joins = []
    real = negatives.materialize

    def seen(df, purpose):
        if purpose in ("home_leaf", "search"):
            df.collect()  # so that the plan is the last one of adaptive execution
            plan = df._jdf.queryExecution().executedPlan().toString()
            joins.append(set(re.findall(r"(\w+Join)(?:\(skew=true\))? \[leaf#", plan)))
        return real(df, purpose)

    monkeypatch.setattr(negatives, "materialize", seen)
    rows = [(i, v, i % 3) for i, v in enumerate(vectors(200, 3, 11))]
    usable = integer_vectors(table(spark, rows), "embedding", "vec_id", "label")
    got = sorted(tuple(r) for r in mine_negatives(usable, F.col("vec_id") % 10 == 0).collect())
    assert got == brute_negatives(rows, lambda i: i % 10 == 0)
    assert joins == [{"SortMergeJoin"}] * 4


def test_ranges_rule_out_leaves_but_never_one_that_is_needed():
    random = np.random.default_rng(5)
    points = np.round(np.vstack([random.normal(size=(80, 4)) * 3 + random.normal(size=4) * 200 for _ in range(20)])).astype(np.int64)
    square = float((points**2).sum(axis=1).max())
    tree = Tree(square)
    up = lifted(points, square)
    tree.grow(up[::4], 8)
    for node in tree.nodes:
        node.least, node.most = np.full((len(node.splits),) * 2, np.inf), np.full((len(node.splits),) * 2, -np.inf)
    for number, _, far, child in tree.walk(up):
        node = tree.nodes[number]
        for j in np.unique(child):
            node.least[:, j] = np.minimum(node.least[:, j], far[child == j].min(axis=0))
            node.most[:, j] = np.maximum(node.most[:, j], far[child == j].max(axis=0))
    leaf = tree.leaf_of(up)
    queries = points[::7]
    scores = queries @ points.T
    high = np.quantile(scores, 0.98, axis=1).astype(np.int64)
    low = np.quantile(scores, 0.96, axis=1).astype(np.int64)
    at = flat(queries)
    assert distances(at, up) == pytest.approx(np.sqrt((queries**2).sum(axis=1)[:, None] + square - 2 * scores), rel=1e-6, abs=1e-3)
    reached = {(k, int(q)) for k, index in tree.reached(at, tree.radius(at, high), tree.radius(at, low)) for q in index}
    needed = {(int(leaf[r]), q) for q, r in zip(*np.nonzero((scores >= low[:, None]) & (scores <= high[:, None])), strict=True)}
    assert needed <= reached and len(reached) < 0.5 * tree.leaves * len(queries)


def test_inner_products_beyond_doubles_are_exact():
    left = np.array([[2**30 + 1, 3]], dtype=np.int64)
    assert inner_products(left, left).tolist() == [[(2**30 + 1) ** 2 + 9]]
