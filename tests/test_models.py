"""Models against brute force on a small design matrix."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from brooktext.functions.features import hash_features, with_norm, with_terms
from brooktext.functions.labels import stable_index
from brooktext.functions.linear import with_prediction
from brooktext.functions.sharded import nb_weight_table, sgd_weight_table, with_sharded_prediction
from brooktext.operators import kmeans, kmeans_many, linear_sgd, logistic, naive_bayes, perceptron
from brooktext.operators.local_steps import local_updates
from brooktext.operators.sums import fetch_sums, slot_sums
from brooktext.streaming.learners import (
    MODELS,
    ModelSet,
    score_metrics,
    stacked_predictions,
    update_models,
)

WIDTH = 50


@pytest.fixture
def rows(records):
    labelled = records.withColumn("label", stable_index(["4", "0"]))
    return with_terms(hash_features(labelled, WIDTH), WIDTH).persist()


@pytest.fixture
def dense(rows):
    """Row ids, matrix with a bias column and labels, in id order."""
    fetched = rows.orderBy("row_id").collect()
    x = np.zeros((len(fetched), WIDTH + 1))
    for i, row in enumerate(fetched):
        for term in row.terms:
            x[i, term.slot] = term["count"]
    return x, np.array([row.label for row in fetched])


def fit(rows, coefficients):
    return fetch_sums(slot_sums(rows, coefficients), WIDTH)


def sgd_step(rows, state, loss):
    rows = rows.withColumn("sgd_margin", linear_sgd.sgd_margin(state))
    return linear_sgd.sgd_update(state, fit(rows, linear_sgd.sgd_coefficients(loss)))


def kmeans_step(rows, state):
    rows = rows.withColumn("kmeans_margin", kmeans.kmeans_margin(state))
    return kmeans.kmeans_update(state, fit(rows, kmeans.kmeans_coefficients()))


def margins(rows, weights):
    scored = with_prediction(rows, weights, "margin").orderBy("row_id").collect()
    return np.array([r.margin for r in scored]), np.array([r.prediction for r in scored])


def test_naive_bayes(rows, dense):
    x, y = dense
    state = naive_bayes.nb_update(None, fit(rows, naive_bayes.nb_coefficients()))
    terms = x[:, :-1]
    log_chance = []
    for c in (0, 1):
        n = terms[y == c].sum(axis=0)
        theta = np.log(n + 1e-4) - math.log(n.sum() + 1e-4 * WIDTH)
        log_chance.append(terms @ theta + math.log((y == c).mean()))
    margin, prediction = margins(rows, naive_bayes.nb_weights(state))
    np.testing.assert_allclose(margin, log_chance[1] - log_chance[0], rtol=1e-9, atol=1e-9)
    np.testing.assert_array_equal(prediction, log_chance[1] > log_chance[0])


def test_naive_bayes_never_predicts_an_unseen_class(rows):
    seen = rows.where(F.col("label") == 0)
    state = naive_bayes.nb_update(None, fit(seen, naive_bayes.nb_coefficients()))
    margin, prediction = margins(rows, naive_bayes.nb_weights(state))
    assert (margin == -np.inf).all() and (prediction == 0).all()


@pytest.mark.parametrize("loss", linear_sgd.LOSSES)
def test_sgd_steps(rows, dense, loss):
    x, y = dense
    state, w = None, np.zeros(WIDTH + 1)
    for step in range(4):
        state = sgd_step(rows, state, loss)
        m = x @ w
        if loss == "log":
            r = 1 / (1 + np.exp(-m)) - y
        else:
            r = np.where((2 * y - 1) * m <= 1, 1 - 2 * y, 0)
        rate = 1 / (1e-4 * (1000 + step))
        shrink = np.append(np.full(WIDTH, 1 - rate * 1e-4), 1.0)
        w = w * shrink - rate * (x * r[:, None]).mean(axis=0)
        np.testing.assert_allclose(state["weight"], w, rtol=1e-9, atol=1e-9)
    assert state["step"][-1] == 4


@pytest.mark.parametrize("loss", linear_sgd.LOSSES)
def test_sgd_learns_separable_rows(rows, loss):
    at_zero = rows.agg(F.avg(linear_sgd.loss_value(F.lit(0.0), loss))).first()[0]
    state, losses = None, [at_zero]
    for _ in range(12):
        state = sgd_step(rows, state, loss)
        scored = with_prediction(rows, linear_sgd.sgd_weights(state), "margin")
        losses.append(scored.agg(F.avg(linear_sgd.loss_value(F.col("margin"), loss))).first()[0])
    assert losses[-1] < losses[0]


def test_kmeans_start_and_steps(rows, dense):
    x, _ = dense
    x = x[:, :-1]
    state = kmeans.kmeans_start(rows, WIDTH)
    c = [x[0], x[np.argmax(((x - x[0]) ** 2).sum(axis=1))]]
    np.testing.assert_array_equal(state["i0"][:-1], c[0])
    np.testing.assert_array_equal(state["i1"][:-1], c[1])
    sums, sizes = [np.zeros(WIDTH), np.zeros(WIDTH)], [0, 0]
    for _ in range(3):
        d = [((x - centre) ** 2).sum(axis=1) for centre in c]
        margin, nearer = margins(rows, kmeans.kmeans_weights(state))
        np.testing.assert_allclose(margin, d[0] - d[1], rtol=1e-9, atol=1e-9)
        state = kmeans_step(rows, state)
        for j in (0, 1):
            sums[j] += x[nearer == j].sum(axis=0)
            sizes[j] += (nearer == j).sum()
            c[j] = sums[j] / sizes[j] if sizes[j] else c[j]
        for got, want in zip(kmeans.kmeans_centres(state), c):
            np.testing.assert_allclose(got, want)


def test_kmeans_of_identical_rows_gives_cluster_zero(rows):
    same = rows.where(F.col("row_id") == 0).select("row_id", "terms")
    state = kmeans.kmeans_start(same, WIDTH)
    state = kmeans_step(same, state)
    assert margins(same, kmeans.kmeans_weights(state))[1].tolist() == [0.0]


def newton_optimum(x, y):
    """The optimum by plain Newton steps on the dense matrix."""
    w, penalty = np.zeros(x.shape[1]), np.append(np.ones(x.shape[1] - 1), 0.0)
    for _ in range(60):
        chance = 1 / (1 + np.exp(-(x @ w)))
        gradient = x.T @ (chance - y) + penalty * w
        w -= np.linalg.solve((x * (chance * (1 - chance))[:, None]).T @ x + np.diag(penalty), gradient)
    return w


def test_logistic_regression_is_at_its_optimum(rows, dense):
    x, y = dense
    state = logistic.lr_fit(rows, WIDTH)
    np.testing.assert_allclose(state["weight"], newton_optimum(x, y), atol=1e-6)
    assert state["gradient"][0] < logistic.TOLERANCE and 2 < state["iterations"][0] < 20
    # From the optimum there is nothing to do; from that of nearly the same rows less than from zero.
    assert logistic.lr_fit(rows, WIDTH, state)["iterations"][0] == 0
    near = logistic.lr_fit(rows.where("row_id != 13"), WIDTH, state)
    cold = logistic.lr_fit(rows.where("row_id != 13"), WIDTH)
    np.testing.assert_allclose(near["weight"], cold["weight"], atol=1e-4)
    assert near["iterations"][0] < cold["iterations"][0]
    # A start far off, where whole steps overshoot, ends at the same place.
    far = logistic.lr_fit(rows, WIDTH, {"weight": np.where(np.arange(WIDTH + 1) % 2, 30.0, -30.0)})
    np.testing.assert_allclose(far["weight"], state["weight"], atol=1e-4)


def test_cross_validation_equals_plain_folds(rows, dense):
    x, y = dense
    ids = np.array([r.row_id for r in rows.orderBy("row_id").collect()])
    want = []
    for k in range(logistic.FOLDS):
        out = ids % logistic.FOLDS == k
        predicted = x[out] @ newton_optimum(x[~out], y[~out]) > 0
        if 0 < y[out].sum() < out.sum():
            want.append(1 - ((predicted - y[out]) ** 2).sum() / ((y[out] - y[out].mean()) ** 2).sum())
    got = logistic.lr_grid_search(rows, WIDTH)
    assert [limit for limit, _ in got] == logistic.GRID_MAX_ITER
    assert [score for _, score in got] == pytest.approx([np.mean(want)] * 2)
    fits = logistic.cross_fits(rows, WIDTH, 50, logistic.fold_of())
    for k, fit in enumerate(fits):
        np.testing.assert_allclose(fit.weight, newton_optimum(x[ids % 5 != k], y[ids % 5 != k]), atol=1e-5)
    short = logistic.cross_fits(rows, WIDTH, 1, logistic.fold_of())
    assert {fit.iterations for fit in short} == {1}


def test_logistic_regression_of_no_rows_or_one_class(rows):
    empty = logistic.lr_fit(rows.where("false"), WIDTH)
    assert not empty["weight"].any() and empty["iterations"][0] == 0
    one = logistic.lr_fit(rows.where("label = 0"), WIDTH)
    assert one["weight"][-1] < -1 and np.isfinite(one["weight"]).all()
    with pytest.raises(ValueError, match="width"):
        logistic.lr_fit(rows, logistic.MOST_WIDTH + 1)


def plain_steps(x, y, size, passes, loss):
    """The same steps on a plain matrix: the linear classifier and the perceptron, rows in order."""
    lengths = np.maximum(np.sqrt((x[:, :-1] ** 2).sum(axis=1, keepdims=True)), 1)
    x = np.hstack([x[:, :-1] / lengths, np.ones((len(x), 1))])
    w, t = np.zeros(WIDTH + 1), 0
    net = perceptron.mlp_state(None, WIDTH)
    first, deep = np.stack([net[f"unit{k}"] for k in range(5)], axis=1), net["deep"]
    moments = [[np.zeros_like(v), np.zeros_like(v)] for v in (first, deep)]
    for _ in range(passes):
        for a in range(0, len(x), size):
            own, label, n = x[a : a + size], y[a : a + size], len(x[a : a + size])
            m = own @ w
            r = 1 / (1 + np.exp(-m)) - label if loss == "log" else np.where((2 * label - 1) * m <= 1, 1 - 2 * label, 0)
            rate = 1 / (1e-4 * (1000 + t))
            w = w * np.append(np.full(WIDTH, 1 - rate * 1e-4), 1.0) - rate * own.T @ r / n
            t += 1
            second, out = deep[:10].reshape(5, 2), deep[12:14]
            h = np.maximum(own @ first, 0)
            z = np.maximum(h @ second + deep[10:12], 0)
            delta = 1 / (1 + np.exp(-(z @ out + deep[14]))) - label
            top = delta[:, None] * out * (z > 0)
            unit = (top @ second.T) * (h > 0)
            slopes = [own.T @ unit / n, np.concatenate([(h.T @ top).ravel(), top.sum(0), z.T @ delta, [delta.sum()]]) / n]
            slopes[0][:-1] += 1e-5 / n * first[:-1]
            slopes[1] += 1e-5 / n * deep * np.array([1] * 10 + [0, 0, 1, 1, 0])
            for value, slope, held in zip((first, deep), slopes, moments, strict=True):
                held[0] = 0.9 * held[0] + 0.1 * slope
                held[1] = 0.999 * held[1] + 0.001 * slope**2
                value -= 0.05 * np.sqrt(1 - 0.999**t) / (1 - 0.9**t) * held[0] / (np.sqrt(held[1]) + 1e-8)
    return w, first, deep, t


@pytest.mark.parametrize("loss", linear_sgd.LOSSES)
def test_a_batch_of_one_partition_is_plain_sequential_steps(rows, dense, loss):
    x, y = dense
    ordered = rows.coalesce(1).sortWithinPartitions("row_id")
    states = local_updates(ordered, {}, ("SGD", "MLP"), WIDTH, loss, passes=3, size=4)
    w, first, deep, steps = plain_steps(x, y, 4, 3, loss)
    np.testing.assert_allclose(states["SGD"]["weight"], w, atol=1e-9)
    np.testing.assert_allclose(np.stack([states["MLP"][f"unit{k}"] for k in range(5)], axis=1), first, atol=1e-9)
    np.testing.assert_allclose(states["MLP"]["deep"], deep, atol=1e-9)
    assert states["SGD"]["step"].tolist() == states["MLP"]["step"].tolist() == [steps] == [9]
    # Scores are those of the net on the plain matrix.
    scored = perceptron.with_layers(with_norm(rows), states["MLP"]).orderBy("row_id").collect()
    lengths = np.maximum(np.sqrt((x[:, :-1] ** 2).sum(axis=1, keepdims=True)), 1)
    h = np.maximum(np.hstack([x[:, :-1] / lengths, np.ones((len(x), 1))]) @ first, 0)
    z = np.maximum(h @ deep[:10].reshape(5, 2) + deep[10:12], 0)
    np.testing.assert_allclose([r.mlp_margin for r in scored], z @ deep[12:14] + deep[14], atol=1e-9)


def test_states_are_averaged_by_rows(spark, rows):
    """Three tasks of unlike sizes: the state is the row-weighted mean of what each gives alone."""
    cuts = [(0, 2), (2, 11), (11, 99)]
    parts = [rows.where((F.col("row_id") >= a) & (F.col("row_id") < b)).coalesce(1) for a, b in cuts]
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")  # else the union of single tasks is one task
    start = local_updates(rows.coalesce(1), {}, ("SGD", "MLP"), WIDTH, "log", passes=1)
    both = local_updates(parts[0].union(parts[1]).union(parts[2]), start, ("SGD", "MLP"), WIDTH, "log", passes=2, size=3)
    spark.conf.unset("spark.sql.unionOutputPartitioning")
    alone = [local_updates(part, start, ("SGD", "MLP"), WIDTH, "log", passes=2, size=3) for part in parts]
    weights = [part.count() for part in parts]
    for model, state in both.items():
        for name, vector in state.items():
            each = [a[model][name] for a in alone]
            want = np.max(each, axis=0) if name == "step" else np.average(each, axis=0, weights=weights)
            np.testing.assert_allclose(vector, want, atol=1e-12)


def test_no_rows_leave_the_states_as_they_are(rows):
    assert local_updates(rows.where("false"), {}, ("SGD", "MLP"), WIDTH, "log") == {}
    start = local_updates(rows, {}, ("SGD",), WIDTH, "log")
    after = local_updates(rows.where("false"), start, ("SGD", "MLP"), WIDTH, "log")
    assert list(after) == ["SGD"] and after["SGD"]["weight"].tolist() == start["SGD"]["weight"].tolist()


def test_local_solvers_learn_and_rerun_alike(rows, dense):
    _, y = dense
    runs = []
    for _ in range(2):
        states = {}
        for _ in range(6):
            states = local_updates(rows, states, ("SGD", "MLP"), WIDTH, "log", size=4)
        runs.append(states)
    for name, state in runs[0].items():
        for vector in state:
            np.testing.assert_allclose(state[vector], runs[1][name][vector])
    metrics = {r.model: r for r in score_metrics(rows, ModelSet(states)).collect()}
    for name in ("SGD", "MLP"):
        assert metrics[name].accuracy > max(np.mean(y), 1 - np.mean(y))
        assert metrics[name].tp > 0 and metrics[name].tn > 0


def test_all_models_together_equal_each_alone(rows):
    both, fitted = update_models(rows, ModelSet(), (6, 4), MODELS, WIDTH)
    assert sorted(fitted) == sorted(MODELS)
    for name in MODELS:
        alone, _ = update_models(rows, ModelSet(), (6, 4), (name,), WIDTH)
        for vector in alone.states[name]:
            np.testing.assert_allclose(alone.states[name][vector], both.states[name][vector])
    assert {r.model: r.n for r in score_metrics(rows, both).collect()} == {name: 10 for name in MODELS}
    assert stacked_predictions(rows, both).count() == 50


def test_one_class_batch_skips_logistic_regression_only(rows):
    seen = rows.where(F.col("label") == 0)
    models, fitted = update_models(seen, ModelSet(), (6, 0), MODELS, WIDTH)
    assert sorted(fitted) == ["KMEANS", "MLP", "MNB", "SGD"]
    assert "LR" not in models.names()


def test_linear_models_share_one_pass(rows):
    coefficients = naive_bayes.nb_coefficients() | linear_sgd.sgd_coefficients("log")
    plan = slot_sums(rows.withColumn("sgd_margin", F.lit(0.0)), coefficients)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


@pytest.mark.parametrize("model", ["MNB", "SGD"])
def test_sharded_weights_score_as_the_literal_ones(spark, rows, model):
    coefficients = naive_bayes.nb_coefficients() | linear_sgd.sgd_coefficients("log")
    sums = slot_sums(rows.withColumn("sgd_margin", F.lit(0.0)), coefficients)
    fetched = fetch_sums(sums, WIDTH)
    if model == "MNB":
        weights, table = naive_bayes.nb_weights(naive_bayes.nb_update(None, fetched)), nb_weight_table(sums, WIDTH)
    else:
        weights, table = linear_sgd.sgd_weights(linear_sgd.sgd_update(None, fetched)), sgd_weight_table(sums, rows.count())
    # Rows with slots that the table does not have, as new texts bring them, and one row twice.
    kept = table[0].where("slot % 3 != 1")
    known = fetched["rows"] > 0
    dense = np.where(known & (np.arange(WIDTH + 1) % 3 != 1), weights, table[1])
    scored = with_sharded_prediction(rows.union(rows.where("row_id = 1")), kept, table[1]).orderBy("row_id").collect()
    margin, prediction = margins(rows.union(rows.where("row_id = 1")), dense)
    np.testing.assert_allclose([r.margin for r in scored], margin, atol=1e-9)
    assert [r.prediction for r in scored] == prediction.tolist()


def test_sharded_naive_bayes_never_predicts_an_unseen_class(rows):
    seen = rows.where(F.col("label") == 0)
    table = nb_weight_table(slot_sums(seen, naive_bayes.nb_coefficients()), WIDTH)
    scored = with_sharded_prediction(rows, *table).collect()
    assert all(r.margin == -math.inf and r.prediction == 0 for r in scored)


def plain_inertia(x, centres):
    return ((x[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum()


@pytest.fixture
def clumps(spark):
    """Rows in six clumps of unlike sizes, one row far off, as a feature frame and a matrix."""
    random = np.random.default_rng(8)
    centres = random.integers(0, 60, (6, 12))
    x = np.vstack([c + random.integers(0, 4, (n, 12)) for c, n in zip(centres, (90, 60, 30, 20, 10, 5), strict=True)] + [np.full((1, 12), 300)])
    sparse = [(i, [int(k) for k in np.flatnonzero(row)], [float(v) for v in row[row > 0]]) for i, row in enumerate(x)]
    df = spark.createDataFrame(sparse, "row_id long, slots array<int>, counts array<double>").repartition(3)
    to_vector = F.udf(lambda s, c: Vectors.sparse(12, s, c), VectorUDT())
    return df.withColumn("features", to_vector("slots", "counts")).persist(), x.astype(float)


def test_parallel_start_is_better_than_two_far_rows(clumps):
    rows, x = clumps
    assert kmeans_many.inertia(rows, x[:2]) == pytest.approx(plain_inertia(x, x[:2]))
    start = kmeans_many.parallel_start(rows, 12, 7)
    assert len(start) == 7
    np.testing.assert_array_equal(start, kmeans_many.parallel_start(rows, 12, 7))
    far = np.array([x[0], x[((x - x[0]) ** 2).sum(axis=1).argmax()]])
    assert plain_inertia(x, start) < 0.05 * plain_inertia(x, far)
    # No more centres than different rows; none without rows.
    same = rows.where("row_id < 1").union(rows.where("row_id < 1"))
    assert len(kmeans_many.parallel_start(same, 12, 5)) == 1
    assert kmeans_many.many_update(None, rows.where("false"), 12, 5) is None


def test_many_centres_update_by_running_means(clumps):
    rows, x = clumps
    start = x[[0, 100, 160]]
    state = {"start": start.ravel(), "sums": np.zeros(start.size), "counts": np.zeros(3)}
    sums, n, c = np.zeros((3, 12)), np.zeros(3), start.copy()
    for a, b in ((0, 120), (120, 217)):
        state = kmeans_many.many_update(state, rows.where(f"row_id >= {a} AND row_id < {b}"), 12, 3, reassign=False)
        nearest = ((x[a:b, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        for j in range(3):
            sums[j] += x[a:b][nearest == j].sum(axis=0)
            n[j] += (nearest == j).sum()
            c[j] = sums[j] / n[j] if n[j] else c[j]
        np.testing.assert_allclose(kmeans_many.centres_of(state), c)
        assert state["counts"].tolist() == n.tolist()


def test_starving_centres_move_to_far_rows(clumps):
    rows, x = clumps
    rows, x = rows.where("row_id < 215"), x[:215]
    start = np.vstack([x[0], np.full(12, -900.0), np.full(12, -800.0)])
    state = {"start": start.ravel(), "sums": np.zeros(start.size), "counts": np.zeros(3)}
    kept = kmeans_many.many_update(state, rows, 12, 3, reassign=False)
    moved = kmeans_many.many_update(state, rows, 12, 3)
    assert kept["counts"].tolist() == moved["counts"].tolist() == [215, 0, 0]
    mean = x.mean(axis=0)
    order = np.argsort(-((x - mean) ** 2).sum(axis=1), kind="stable")
    np.testing.assert_allclose(kmeans_many.centres_of(moved), np.vstack([mean, x[order[:2]]]))
    after = kmeans_many.many_update(moved, rows, 12, 3)
    assert after["counts"].min() > 0
    assert kmeans_many.inertia(rows, kmeans_many.centres_of(after)) < kmeans_many.inertia(rows, kmeans_many.centres_of(kept))
