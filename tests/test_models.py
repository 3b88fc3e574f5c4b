"""Models: optimality, agreement with direct computation, scores on clear classes."""

import math
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.models import ensemble, tune
from sparktab.models.bayes import GaussianNB
from sparktab.models.boosting import adaboost
from sparktab.models.calibrate import coupled, sigmoids
from sparktab.models.kernel import Fourier, Kernel, KernelSVM, Landmarks, Monomials, TensorSketch, candidates_of, mapped, rbf_svm
from sparktab.models.learner import predict
from sparktab.models.linear import linear_svm, logreg
from sparktab.models.margin import SquaredHinge
from sparktab.models.mlp import backward, batch_loss, flatten, forward, initial_weights, mlp, one_hot, unflatten
from sparktab.models import nca
from sparktab.models.nca import _in_parts, bagged_knn, by_cells, hit_chance, joined_sums, merged, moments, nca_block, nca_fit, row_sums, scatter, slope, swept
from sparktab.models.trees import gbt, out_of_bag, random_forest
from sparktab.operators import split
from sparktab.operators.encode import fit_label
from sparktab.operators.metrics import evaluate
from sparktab.plans import workflows

AB = ("a", "b")

LEARNERS = {
    "bayes": GaussianNB(AB, "y"),
    "logistic": logreg(AB, "y"),
    "linear svm": linear_svm(AB, "y"),
    "rbf": rbf_svm(AB, "y", C=10.0, n_components=40),
    "poly": KernelSVM(AB, "y", kernel="poly", degree=2),
    "forest": random_forest(AB, "y", trees=10, depth=6),
    "boosted": gbt(AB, "y", rounds=30, depth=3, weighting=None),  # a tree sees one of the two columns
    "adaboost": adaboost(AB, "y", rounds=12),
    "mlp": mlp(AB, "y", "key", hidden=(12,), lr=0.3, dropout=0.0, epochs=15, batch=32),
}


@pytest.mark.parametrize("name", LEARNERS)
def test_clear_classes_are_learned(blobs, name):
    train, test = split.train_test(blobs, "key", "y")
    out = LEARNERS[name].fit(train).transform(test)
    assert out.columns[-2:] == ["prediction", "probability"]
    assert evaluate(out, "y")["f1_macro"] > 0.95


def test_logistic_optimum(spark):
    """The gradient of ``C * weighted loss + |b|^2 / 2`` vanishes at the fit."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=200) > 0.7).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(t)) for (a, b), t in zip(x, y)], "a double, b double, y int")
    C = 0.3
    model = logreg(AB, "y", C, scale=None, tol=1e-12).fit(df).model
    w = np.where(y == 1, 200 / (2 * y.sum()), 200 / (2 * (1 - y).sum()))
    beta = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ beta + model.intercept)))
    assert np.abs(C * x.T @ (w * (p - y)) + beta).max() < 1e-4
    assert abs((w * (p - y)).sum()) < 1e-4


def test_naive_bayes_equals_direct_computation(spark):
    data = [(1, 0.0, 1.0, 0), (2, 0.5, 1.5, 0), (3, 3.0, 1.0, 1), (4, 3.5, 4.0, 1), (5, 2.5, 2.0, 1)]
    df = spark.createDataFrame(data, "key int, a double, b double, y int")
    got = {r["key"]: r["probability"] for r in GaussianNB(AB, "y").fit(df).transform(df).collect()}
    x, y = np.array([d[1:3] for d in data]), np.array([d[3] for d in data])
    eps = 1e-9 * x.var(0).max()
    logs = np.stack([math.log((y == c).mean()) - 0.5 * (np.log(2 * np.pi * (x[y == c].var(0) + eps)) + (x - x[y == c].mean(0)) ** 2 / (x[y == c].var(0) + eps)).sum(1) for c in (0, 1)], 1)
    want = np.exp(logs - logs.max(1, keepdims=True))
    want /= want.sum(1, keepdims=True)
    assert np.array([got[k] for k in range(1, 6)]) == pytest.approx(want)


@pytest.mark.parametrize("kind", ["int", "string"])
def test_naive_bayes_statistics_of_many_columns(spark, kind):
    names = tuple(f"c{i}" for i in range(12))
    df = spark.range(600).select(*[(F.hash("id", F.lit(i)) % 100 * 1.0 + F.col("id") % 3).alias(c) for i, c in enumerate(names)], (F.col("id") % 3).cast(kind).alias("y"))
    wide, narrow = GaussianNB(names, "y").fit(df), GaussianNB(names[:3], "y").fit(df)
    assert wide.classes == narrow.classes and wide.prior == narrow.prior
    for c in wide.classes:
        assert wide.mean[c][:3] == pytest.approx(narrow.mean[c]) and wide.var[c][:3] == pytest.approx(narrow.var[c])
    assert wide.transform(df).where("prediction IS NULL").count() == 0


def points(spark, n=60, d=3):
    pts = np.random.default_rng(0).normal(size=(n, d))
    return pts, spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(pts)], "id int, x array<double>").repartition(4)


def inner_products(df, f):
    z = np.array([r["z"] for r in mapped(df, F.col("x"), f, "z").orderBy("id").collect()])
    return z @ z.T


def test_kernel_maps_have_the_kernel_as_inner_product(spark):
    pts, df = points(spark)
    distance = ((pts[:, None] - pts[None]) ** 2).sum(2)
    for degree, coef0, gamma in ((2, 1.0, 0.5), (3, 0.0, 0.7), (3, 2.5, 0.2)):
        got = inner_products(df, Monomials(3, Kernel("poly", gamma, degree, coef0)))
        assert np.allclose(got, (gamma * pts @ pts.T + coef0) ** degree)
    assert np.abs(inner_products(df, Fourier(3, 0.5, 4000, 1)) - np.exp(-0.5 * distance)).max() < 0.1
    rows = np.sort(candidates_of(df, F.col("x"), 3, 500, 1), axis=0)
    assert np.allclose(rows, np.sort(pts, axis=0))
    assert np.allclose(inner_products(df, Landmarks(rows_of(df), Kernel("rbf", 0.5), 60, 1)), np.exp(-0.5 * distance), atol=1e-6)  # a landmark each: exact
    some = Landmarks(rows_of(df), Kernel("rbf", 0.1), 40, 1)
    assert some.error < 0.005 and np.abs(inner_products(df, some) - np.exp(-0.1 * distance)).max() < 0.1
    sketch = inner_products(df, TensorSketch(3, Kernel("poly", 0.5, 2, 1.0), 8192, 1))
    want = (0.5 * pts @ pts.T + 1) ** 2
    assert np.abs(sketch - want).mean() < 0.05 * np.abs(want).mean()


def rows_of(df):
    return np.array([r["x"] for r in df.orderBy("id").collect()])


def test_landmark_candidates_are_bounded_and_different(spark):
    """A row that fills the table is one candidate; missing and infinite rows are none."""
    df = spark.range(30000).select(F.when(F.col("id") < 20000, F.array(F.lit(1.0), F.lit(2.0))).otherwise(F.array(F.col("id") * 1.0, F.lit(0.5))).alias("x"))
    extra = spark.createDataFrame([([None, 1.0],), ([float("inf"), 1.0],), ([float("nan"), 1.0],), (None,)], "x array<double>")
    found = candidates_of(df.unionByName(extra), F.col("x"), 2, 100, 7)
    assert found.shape == (100, 2) and len(np.unique(found, axis=0)) == 100 and np.isfinite(found).all()
    assert candidates_of(extra, F.col("x"), 2, 100, 7).shape == (0, 2)


def test_kernel_machine_edges(spark):
    """A circle inside a ring; rows with a missing measure get neither class nor probabilities."""
    rng = np.random.default_rng(2)
    angle, radius = rng.uniform(0, 6.28, 300), np.repeat([1.0, 3.0], 150) + rng.normal(0, 0.2, 300)
    rows = [(i, float(r * np.cos(t)), float(r * np.sin(t)), int(i >= 150)) for i, (t, r) in enumerate(zip(angle, radius))]
    df = spark.createDataFrame(rows, "key int, a double, b double, y int")
    for learner in (rbf_svm(AB, "y"), KernelSVM(AB, "y", kernel="poly", degree=2, coef0=1.0), rbf_svm(AB, "y", approximation="fourier")):
        model = learner.fit(df)
        out = model.transform(df)
        assert evaluate(out, "y")["f1"] > 0.97
        sure = out.select((F.col("probability")[1]).alias("p"), "y").toPandas()
        assert (-(sure.y * np.log(sure.p) + (1 - sure.y) * np.log(1 - sure.p))).mean() < 0.2
        missing = model.transform(spark.createDataFrame([(1, None, 2.0)], "key int, a double, b double")).first()
        assert missing["prediction"] is None and missing["probability"] is None
    none = rbf_svm(AB, "y").fit(df.limit(0)).transform(df)
    assert none.count() == 300


def test_pairwise_coupling_gives_back_consistent_shares():
    """Pair probabilities made from shares lead to these shares; rows sum to one."""
    p = np.random.default_rng(3).dirichlet([1, 2, 3, 1], 50)
    problems = [(a, b) for a in range(4) for b in range(a + 1, 4)]
    assert np.allclose(coupled(np.column_stack([p[:, a] / (p[:, a] + p[:, b]) for a, b in problems]), problems, 4), p)
    wild = coupled(np.random.default_rng(4).uniform(0.01, 0.99, (50, 6)), problems, 4)
    assert np.allclose(wild.sum(axis=1), 1) and (wild >= 0).all()


def test_sigmoids_find_the_line_that_made_the_labels(spark):
    """Labels drawn with known chances: the fitted chances are the drawn ones; margins without a relation to the labels say the class share."""
    rng = np.random.default_rng(5)
    f = rng.normal(size=(8000, 1)) * 2
    y = (rng.uniform(size=8000) < 1 / (1 + np.exp(-(1.5 * f[:, 0] - 0.5)))).astype(int)
    rows = spark.createDataFrame([([float(v)], int(t)) for (v,), t in zip(f, y)], "margins array<double>, y int").repartition(5)
    assert sigmoids(rows, [(1, None)])[0] == pytest.approx([1.5, -0.5], abs=0.12)
    flipped = spark.createDataFrame([([float(-v)], int(t)) for (v,), t in zip(f, y)], "margins array<double>, y int")
    slope, at = sigmoids(flipped, [(1, None)])[0]
    assert slope == 0 and 1 / (1 + np.exp(-at)) == pytest.approx(y.mean(), abs=1e-3)


def test_penalties_solved_together_are_those_solved_alone(blobs):
    together = SquaredHinge(AB, "y", pairs=True).fit_all(blobs, [0.1, 5.0])
    for C, model in zip((0.1, 5.0), together):
        alone = SquaredHinge(AB, "y", C, pairs=True).fit(blobs)
        assert np.allclose(alone.coefficients, model.coefficients, atol=1e-7) and model.problems == [(0, 1), (0, 2), (1, 2)]
    folded = split.stratified_folds(blobs, "key", "y", 3).cache()
    best, report = tune.penalty_search(lambda p: rbf_svm(AB, "y", n_components=20, probability=False, **p), [{"gamma": 0.5}, {"gamma": "scale"}], [1.0, 10.0], folded, "y")
    assert report.count() == 12 and best == {"gamma": 0.5, "C": 1.0}
    assert report.select("params").distinct().count() == 4


@pytest.mark.parametrize("outputs,activation", [(1, "relu"), (3, "relu"), (3, "sigmoid")])
def test_network_gradient(outputs, activation):
    rng = np.random.default_rng(4)
    sizes = [3, 5, 4, outputs]
    weights = initial_weights(sizes, activation, 2)
    x, w = rng.normal(size=(20, 3)), rng.uniform(0.5, 2, 20)
    target = one_hot(rng.integers(0, max(2, outputs), 20), outputs)
    out, steps = forward(x, weights, activation)
    grad = flatten(backward(out, target, w, steps, weights, activation))
    flat = flatten(weights)
    for i in range(0, len(flat), 7):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        loss = [batch_loss(forward(x, unflatten(f, sizes), activation)[0], target, w) for f in (up, down)]
        assert grad[i] == pytest.approx((loss[0] - loss[1]) / 2e-6, abs=1e-5)


def test_network_history_and_early_stop(blobs):
    train, test = split.train_test(blobs, "key", "side")
    model = mlp(AB, "side", "key", hidden=(4,), lr=0.01, epochs=12, batch=64, patience=2).fit(train, test)
    assert 1 <= len(model.history) <= 12
    assert model.history_frame(blobs.sparkSession).columns == ["epoch", "train_loss", "val_loss", "val_accuracy", "val_f1", "lr"]
    best = max(h["val_f1"] for h in model.history)
    if best > 0:
        assert evaluate(model.transform(test), "side")["f1"] == pytest.approx(best)


def test_nca_gradient_and_ascent(blobs):
    rng = np.random.default_rng(2)
    x, y, A = rng.normal(size=(25, 3)), rng.integers(0, 2, 25), rng.normal(size=(2, 3))
    _, grad = nca_block(A, x, y)
    for i in range(2):
        for j in range(3):
            step = np.zeros_like(A)
            step[i, j] = 1e-6
            numeric = (nca_block(A + step, x, y)[0] - nca_block(A - step, x, y)[0]) / 2e-6
            assert grad[i, j] == pytest.approx(numeric, abs=1e-4)
    df = blobs.select("key", "y", F.array("a", "b").alias("x"))
    track = nca_fit(df, "key", "x", "y", iterations=4, block_rows=100).objective
    assert track[-1] >= track[0]


def test_bagged_neighbours(blobs):
    train, test = split.train_test(blobs, "key", "y")
    out = bagged_knn(train, test, "key", AB, "y", n=2, iterations=2)
    assert out.count() == test.count()
    assert evaluate(out.join(test.select("key", "y"), "key"), "y")["f1_macro"] > 0.95


def test_out_of_bag(blobs):
    assert out_of_bag(random_forest(AB, "y", trees=5, depth=4, key="key"), blobs)["f1_macro"] > 0.9


def test_searches(blobs):
    folded = split.stratified_folds(blobs, "key", "y", 3).cache()
    report = tune.cv_report(lambda p: GaussianNB(AB, "y", **p), [{}, {"smoothing": 5.0}], folded, "y")
    assert report.count() == 6
    assert tune.cv_means(report, "f1_macro").first()["param_id"] == 0
    assert tune.best_fold(report).count() == 1
    train, valid = split.train_test(blobs, "key", "y")
    best, scores = tune.holdout_search(lambda p: GaussianNB(AB, "y", **p), [{"smoothing": 1e-9}, {"smoothing": 1e-9}], train, valid, "y")
    assert best is not None and scores[0][1] == scores[1][1]


def test_neighbour_grid_has_forty_settings(blobs):
    folded = split.stratified_folds(blobs.select("key", "side", "a", "b"), "key", "side", 2).cache()
    out = tune.knn_grid(folded, "key", AB, "side")
    assert out.count() == 80 and out.select("k", "weights", "metric", "p").distinct().count() == 40


def test_stacking_and_choice(blobs):
    two = blobs.where("y < 2").cache()
    bases = {"bayes": GaussianNB(AB, "y"), "logistic": logreg(AB, "y")}
    folded = split.stratified_folds(two, "key", "y", 3, shuffle=False)
    assert evaluate(ensemble.stack(bases, folded, "y", 2).transform(two), "y")["f1"] > 0.95
    choice = workflows.choose_ensemble(bases, two, "key", "y", stacking_folds=None)
    assert choice.method == "equal votes" and choice.scores.count() == 3
    assert evaluate(choice.transform(two), "y")["f1"] > 0.95


def test_stacking_fits_folds_at_once_and_keeps_the_callers_cache(blobs):
    """A fit waits until another one has begun; the table that the caller cached is still cached afterwards."""
    met, folded = threading.Barrier(2, timeout=60), split.stratified_folds(blobs.where("y < 2"), "key", "y", 2, shuffle=False).cache()

    class Waiting(GaussianNB):
        def fit(self, df):
            met.wait()
            return super().fit(df)

    model = ensemble.stack({"one": Waiting(("a",), "y"), "two": GaussianNB(AB, "y")} | {"three": Waiting(AB, "y")}, folded, "y", 2)
    assert list(model.models) == ["one", "two", "three"] and folded.storageLevel.useMemory
    assert evaluate(model.transform(folded), "y")["f1"] > 0.95
    folded.unpersist()


def test_choice_never_skips_blending(blobs):
    """Four models and three classes: blending is tried as well, and its weights are applied."""
    bases = {f"bayes{i}": GaussianNB(f, "y") for i, f in enumerate((("a",), ("b",), AB, ("a",)))}
    choice = workflows.choose_ensemble(bases, blobs, "key", "y", 3, stacking_folds=None)
    scores = {r["method"]: r["f1"] for r in choice.scores.collect()}
    assert set(scores) == {"equal votes", "weighted votes", "blending"} and scores["blending"] > 0.95
    assert evaluate(choice.transform(blobs), "y")["f1"] > 0.95
    two = workflows.choose_ensemble(bases, blobs.where("y < 2"), "key", "y", 2, stacking_folds=None)
    assert two.scores.where("method = 'blending'").count() == 1


def test_class_blends_against_brute_force(spark):
    """Any number of models; rows without shares are misses, rows without a label are left out, the first class wins ties."""
    rng = np.random.default_rng(6)
    shares = rng.dirichlet([1, 1, 1], (200, 3))
    rows = [([float(v) for v in a], [float(v) for v in b], [float(v) for v in c], int(rng.integers(3))) for a, b, c in shares]
    rows += [([0.5, 0.5, 0.0],) * 3 + (1,), (None, [1.0, 0.0, 0.0], [1.0, 0.0, 0.0], 0), ([1.0, 0.0, 0.0],) * 3 + (None,)]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>, c array<double>, y int").repartition(3)
    grid = ensemble.simplex_grid(3, 5)
    assert len(grid) == 6 and all(min(w) > 0 and sum(w) == pytest.approx(1) for w in grid)
    got = {r["ordinal"]: r["f1"] for r in ensemble.blend_search_classes(df, ["a", "b", "c"], "y", 3, grid).collect()}
    for i, w in enumerate(grid):
        pairs = [(y, int(np.argmax(sum(wj * np.array(v) for wj, v in zip(w, s)))) if None not in s else -1) for *s, y in rows if y is not None]
        f1 = [2 * sum(y == g == k for y, g in pairs) / sum((y == k) + (g == k) for y, g in pairs) for k in range(3)]
        assert got[i] == pytest.approx(np.mean(f1))
    assert ensemble.blend_search_classes(df.limit(0), ["a", "b", "c"], "y", 3, grid).select("f1").distinct().collect() in ([], [(0.0,)])


def test_holdout_by_ids_decodes(spark, blobs):
    named = blobs.withColumn("c", F.when(F.col("y") == 0, "p").when(F.col("y") == 1, "q").otherwise("r")).drop("y")
    coder = fit_label(named, "c")
    df = coder.encode(named, "y").withColumn("y", F.col("y").cast("int"))
    scored, report, f1 = workflows.evaluate_holdout(df, spark.range(90).toDF("key"), "key", "y", GaussianNB(AB, "y"), coder)
    assert scored.count() == 90 and f1 > 0.95
    assert {r["class"] for r in report.collect()} == {"p", "q", "r", "accuracy", "macro avg", "weighted avg"}


def test_predict_and_grid(blobs):
    model = GaussianNB(AB, "y").fit(blobs)
    assert predict(model, blobs, "key").columns == ["key", "prediction", "probability"]
    surface = workflows.score_grid(model, blobs, "a", "b", 0.5)
    assert surface.count() == surface.select("a", "b").distinct().count() > 100


def test_network_does_not_depend_on_cores_or_batches(spark, blobs):
    from sparktab.models.mlp import mlp

    found = []
    for cores, arrow in (("8", "10000"), ("2", "37")):
        old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
        for k, v in zip(old, (cores, arrow), strict=True):
            spark.conf.set(k, v)
        try:
            model = mlp(("a", "b"), "y", "key", hidden=(6,), epochs=3, batch=16, shard_rows=100, lr=0.1).fit(blobs.repartition(int(cores)))
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)
        found.append([h["train_loss"] for h in model.history])
    assert found[0] == pytest.approx(found[1], rel=1e-9)


def test_block_pairs_give_the_exact_objective():
    """Sums and scatter over pairs of blocks of any size against the dense formula."""
    rng = np.random.default_rng(8)
    x, y, A = rng.normal(size=(90, 4)), rng.integers(0, 3, 90), rng.normal(size=(2, 4))
    value, grad = nca_block(A, x, y)
    for size in (1, 7, 40, 90):
        blocks = [(x[i : i + size], y[i : i + size]) for i in range(0, 90, size)]
        sums = [joined_sums([row_sums(A, one, other, i == j) for j, other in enumerate(blocks)]) for i, one in enumerate(blocks)]
        assert sum(hit_chance(s).sum() for s in sums) == pytest.approx(value, abs=1e-9)
        whole = sum(scatter(A, one, other, sums[i], i == j) for i, one in enumerate(blocks) for j, other in enumerate(blocks))
        assert np.allclose(2 * A @ whole, grad, atol=1e-8)


def test_learned_map_does_not_depend_on_blocks(blobs):
    df = blobs.select("key", "y", F.array("a", "b", (F.col("a") * F.col("b"))).alias("x"))
    one, many = (nca_fit(df, "key", "x", "y", dim=2, iterations=6, block_rows=n) for n in (2048, 120))
    assert np.allclose(one.A, many.A, atol=1e-6) and np.allclose(one.objective, many.objective, atol=1e-6)
    assert one.objective[-1] > one.objective[0]


def test_squared_hinge_optimum(spark):
    """The gradient of ``|w|^2 / 2 + C * weighted squared hinge`` vanishes at the fit, for every class against the rest."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] + rng.normal(size=300) > 0.5).astype(int) + (x[:, 1] + rng.normal(size=300) > 1).astype(int)
    df = spark.createDataFrame([(*map(float, a), int(t)) for a, t in zip(x, y)], "a double, b double, c double, y int").repartition(5)
    for C in (0.01, 3.0):
        model = linear_svm(("a", "b", "c"), "y", C, scale=None).fit(df)
        weight = np.array([300 / (3 * (y == t).sum()) for t in y])
        z = np.hstack([x, np.ones((300, 1))])
        for k, w in enumerate(model.coefficients):
            s = np.where(y == k, 1, -1)
            gap = np.maximum(0, 1 - s * (z @ w))
            assert np.abs(w - 2 * C * (weight * s * gap) @ z).max() < 1e-6
    assert linear_svm(("a", "b", "c"), "y", scale=None).fit(df.limit(0)).transform(df).count() == 300


def test_moments_give_value_and_gradient_in_one_pass():
    """Moments over blocks of any size, far rows and a class of one row, against the dense formula."""
    g = np.random.default_rng(8)
    x, y, A = g.normal(size=(150, 3)), g.integers(0, 3, 150), g.normal(size=(2, 3))
    x[7], y[9] = 60.0, 5
    value, grad = nca_block(A, x, y)
    for size in (150, 64, 1):
        blocks = [(x[at : at + size], y[at : at + size]) for at in range(0, 150, size)]
        total = 0
        for i, one in enumerate(blocks):
            sums = None
            for j, other in enumerate(blocks):
                sums = merged(sums, moments(A, one, other, i == j))
            total = total + slope(sums, 3)
        assert total[0] == pytest.approx(value, abs=1e-9)
        assert np.allclose(2 * A @ total[1:].reshape(3, 3), grad, atol=1e-7)


def test_ascent_over_blocks_looks_at_every_pair_once(blobs, monkeypatch):
    """Same track as with normalisers first and gradients after; wide vectors still take that way, and larger tables a join without broadcast."""
    df = blobs.select("key", "y", F.array("a", "b").alias("x"))
    want = None
    for narrow, size in ((0, 64 << 20), (8, 64 << 20), (8, 0)):
        with monkeypatch.context() as m:
            m.setattr(nca, "NARROW", narrow)
            m.setattr(nca, "BROADCAST_BYTES", size)
            if narrow:
                m.setattr(nca, "row_sums", None)
            got = nca_fit(df, "key", "x", "y", iterations=3, block_rows=120).objective
        want = want or got
        assert np.allclose(got, want, atol=1e-9)


def test_sums_by_cells_and_tiles_are_the_dense_ones(monkeypatch):
    """Value and gradient without a look at every pair, or with one look: copies, equal rows, far rows, a class of one row, parts of a block."""
    monkeypatch.setattr(nca, "GRID_ROWS", 170)
    monkeypatch.setattr(nca, "TILE", 64)
    g = np.random.default_rng(3)
    x = np.concatenate([g.normal(size=(400, 4)), g.normal(size=(100, 4)) * 8, [[90.0, 0, 0, 0], [0, 0, 400.0, 0]]])
    y, n = g.integers(0, 3, 502), g.integers(1, 4, 502).astype(float)
    x[:60], y[:30], y[499], n[400:] = x[60:120], y[60:90], 7, 1
    for dim in (1, 2, 3):
        A = g.normal(size=(dim, 4))
        value, grad = nca_block(A, np.repeat(x, n.astype(int), axis=0), np.repeat(y, n.astype(int)))
        order = np.argsort(y, kind="stable")
        for sums, copies in ((moments(A, (x, y), (x, y, n), True), n), (swept(A, x[order], y[order], n[order]), n[order])):
            total = slope(sums, 4, copies)
            assert total[0] == pytest.approx(value, abs=1e-9)
            assert np.allclose(2 * A @ total[1:].reshape(4, 4), grad, atol=1e-7)
        if dim < 3:
            got, gradient = by_cells(lambda f, given=None: _in_parts(f, 0, (x, y, n), given), A, 4, 1.0)
            assert got == pytest.approx(value, abs=1e-9)
            assert np.allclose(gradient(), grad, atol=1e-7)


def test_work_of_a_plane_map_grows_with_the_rows(monkeypatch):
    """One measure of 120,000 rows, that is 14 billion pairs, takes no pair of them; the value is right for every 400th row."""
    g = np.random.default_rng(5)
    y = g.integers(0, 4, 120_000)
    x, n, A = g.normal(size=(120_000, 3)) + y[:, None], np.ones(120_000), g.normal(size=(2, 3))
    hits, own = [], _in_parts(lambda place, rows, _: ({}, rows), 0, (x, y, n), None)[1]
    assert sum(len(rows[0]) for rows in own) == 120_000
    monkeypatch.setattr(nca, "FAR", 0.0)
    monkeypatch.setattr(nca, "moments", None)

    def each(f, given=None):
        made = _in_parts(f, 0, (x, y, n), given)
        hits.append(made)
        return made

    value, gradient = by_cells(each, A, 3, 120_000)
    assert gradient().shape == (2, 3) and len(hits) == 3
    monkeypatch.undo()
    some = np.arange(0, 120_000, 400)
    want = moments(A, (x[some], y[some]), (x, y), some)
    z = x @ A.T
    every, mine = nca.read_off(nca.placed_rows(z[some], y[some]), nca.fields(hits[0][0], slice(0, 3), slice(0, 3)))
    assert np.allclose((mine[:, 0] - 1) / (every[:, 0] - 1), slope_chances(want, 3), atol=1e-10)
    assert 0 < value < 1


def slope_chances(sums, d):
    width = 1 + d * (d + 1) // 2
    return sums[:, 1 + width] / sums[:, 1]


def test_ways_to_learn_a_map_agree(blobs, monkeypatch):
    """One task, all pairs of blocks, cells in one and in many tasks, cells given up; copies are rows of their own."""
    df = blobs.select("key", "y", F.array("a", "b", (F.col("a") * F.col("b"))).alias("x"), (F.col("key") % 3 + 1).cast("int").alias("copies"))
    rows = df.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    for dim in (2, 3):
        want = nca_fit(rows, "key", "x", "y", dim=dim, iterations=4)
        for size, cells, broadcast in ((2048, 4096, 64 << 20), (100, 4096, 64 << 20), (100, 4096, 0), (100, 0, 0)):
            with monkeypatch.context() as m:
                m.setattr(nca, "CELLS", cells)
                m.setattr(nca, "BROADCAST_BYTES", broadcast)
                got = nca_fit(df, "key", "x", "y", dim=dim, iterations=4, block_rows=size, copies="copies")
            assert np.allclose(got.objective, want.objective, atol=1e-9)
            assert np.allclose(got.A.T @ got.A, want.A.T @ want.A, atol=1e-7)
    for together in (1, 20):
        got = nca_fit(df, "key", "x", "y", iterations=3, block_rows=100, copies="copies", together=together)
        assert np.allclose(got.objective, nca_fit(rows, "key", "x", "y", iterations=3).objective, atol=1e-9)


def test_newton_leaves_out_problems_that_are_done():
    """Quadratics, one of them solved at the start: no pass asks for it again, and a problem that cannot move does not hold up the end."""
    from sparktab.models.margin import STEPS, newton

    goal, asked = np.array([[0.0, 0.0], [3.0, -1.0], [1.0, 1.0]]), []

    def passes(w, step, some):
        asked.append(list(some))
        rows = []
        for i, j in enumerate(some):
            losses = [((w[i] + t * step[i] - goal[j]) ** 2).sum() if j < 2 else 5.0 + (np.abs(step[i]).sum() > 0) for t in STEPS]
            rows.append([*losses, *(2 * (w[i] + step[i] - goal[j])), 2, 0, 0, 2])
        return np.array(rows, dtype=float)

    start = np.zeros((3, 2))
    out = newton(passes, start, np.ones(3), 0.0, 50, 1e-9)
    assert np.allclose(out[1], goal[1]) and not start.any() and (out[[0, 2]] == 0).all()
    assert asked[0] == [0, 1, 2] and all(0 not in a for a in asked[1:]) and len(asked) == 2
