"""Trees on binned features against plain versions, and on one block against many."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.models import binned
from sparktab.models.binned import SCALE, Adaptive, Alone, Bagging, Block, Gini, Newton, Tree, drawn, uniform
from sparktab.models.boosting import adaboost
from sparktab.models.trees import gbt, large_forest, out_of_bag, random_forest
from sparktab.operators.metrics import evaluate

FEATURES = ("a", "b", "c")


@pytest.fixture(scope="module")
def noisy(spark):
    """Three classes that overlap, few distinct values in one column, a missing and an infinite value."""
    g = np.random.default_rng(5)
    y = g.integers(0, 3, 900)
    rows = [(int(i), int(t), float(x), float(z), float(k)) for i, (t, x, z, k) in enumerate(zip(y, y + g.normal(0, 1.1, 900), g.normal(0, 1, 900) - (y == 2), g.integers(0, 4, 900)))]
    rows[3] = (*rows[3][:2], None, float("inf"), float("nan"))
    return spark.createDataFrame(rows, "key long, y int, a double, b double, c double").cache()


def block_of(df, table, weights):
    rows = [r for b in table.blocks.collect() for r in [Block.of(b.asDict())]]
    return Block(np.concatenate([r.bins for r in rows], axis=1), *[np.concatenate([getattr(r, c) for r in rows]) for c in ("y", "w", "h")], np.concatenate([r.state for r in rows]))


def score(g, h, l1, l2):
    t = np.sign(g) * max(abs(g) - l1, 0)
    return t * t / (h + l2)


def plain_newton(bins, g, h, features, depth, l1, l2, min_child, gamma):
    """A tree by trying every cut of every feature at every node; returns the leaf value of every row."""
    out = np.zeros(bins.shape[1])

    def value(rows):
        t = np.sign(g[rows].sum()) * max(abs(g[rows].sum()) - l1, 0)
        return -t / (h[rows].sum() + l2)

    def fit(rows, level):
        best = (1e-6, None)
        if level < depth and (g[rows] != 0).sum() > 1:
            whole = score(g[rows].sum(), h[rows].sum(), l1, l2)
            for f in features:
                for cut in range(bins[f].max()):
                    left, right = rows[bins[f, rows] <= cut], rows[bins[f, rows] > cut]
                    if min(h[left].sum(), h[right].sum()) < min_child:
                        continue
                    gain = score(g[left].sum(), h[left].sum(), l1, l2) + score(g[right].sum(), h[right].sum(), l1, l2) - whole
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, cut, left, right))
        if best[1] is None:
            return [rows], value(rows)
        f, cut, left, right = best[1]
        parts = [fit(side, level + 1) for side in (left, right)]
        if best[0] < gamma and all(len(p[0]) == 1 for p in parts):
            return [rows], value(rows)
        for p, side in zip(parts, (left, right)):
            if len(p[0]) == 1:
                out[side] = p[1]
        return parts[0][0] + parts[1][0], None

    found, alone = fit(np.flatnonzero(h > 0), 0)
    if len(found) == 1:
        out[:] = alone
    return out


def test_boosting_equals_a_plain_version(noisy):
    """Margins after each of four rounds, with both penalties, least gain, and rows drawn by hash."""
    df = noisy.withColumn("y", (F.col("y") > 0).cast("int"))
    learner = gbt(FEATURES, "y", rounds=4, depth=3, rate=0.3, rows=0.7, cols=0.7, gamma=2.0, l1=0.5, l2=3.0, key="key", bins=16)
    model, table = learner._fit(df)
    b = block_of(df, table, None)
    margin = np.zeros(len(b.y))
    for r, (trees, values) in enumerate(model.trees):
        p = 1 / (1 + np.exp(-margin))
        inside = uniform(b.h, 42, r, 1) < 0.7
        g, h = (np.rint(v * inside * SCALE) / SCALE for v in (b.w * (p - b.y), b.w * p * (1 - p)))
        want = plain_newton(b.bins, g, h, sorted(drawn(2, 3, 42, r, 0).tolist()), 3, 0.5, 3.0, 1.0, 2.0)
        got = values[0][trees[0].assign(b.bins)]
        assert np.allclose(got[inside], 0.3 * want[inside], atol=1e-9), r
        margin += got


def test_penalties_shrink_and_prune():
    rule = Newton(l1=1.0, l2=2.0)
    assert rule.leaf(np.array([5.0, 2.0, 9.0]))[0] == pytest.approx(-1.0) and rule.leaf(np.array([-0.5, 2.0, 9.0]))[0] == 0
    t = Tree()
    t.total[0] = np.zeros(3)
    a, _ = t.split(0, 0, 1, 5.0, np.zeros(3))
    t.split(a, 0, 0, 1.0, np.zeros(3))
    t.prune(2.0)
    assert t.feature[a] == -1 and t.feature[0] == 0
    t.prune(6.0)
    assert t.feature[0] == -1


@pytest.mark.parametrize("name", ["boosted", "softmax", "forest", "adaptive"])
def test_blocks_do_not_matter(noisy, name):
    """One task for the whole table, or a job for each level over many blocks: the same trees."""
    make = {
        "boosted": lambda **o: gbt(FEATURES, "y", rounds=3, depth=3, key="key", **o),
        "softmax": lambda **o: gbt(FEATURES, "y", rounds=2, depth=2, weighting=None, key="key", **o),
        "forest": lambda **o: random_forest(FEATURES, "y", trees=4, depth=5, key="key", **o),
        "adaptive": lambda **o: adaboost(FEATURES, "y", rounds=3, key="key", **o),
    }[name]
    df = noisy.withColumn("y", (F.col("y") > 0).cast("int")) if name == "boosted" else noisy
    one, many = make(), make(block_rows=200)
    a, b = one.fit(df), many.fit(df.repartition(5))
    p, q = ([r.probability for r in m.transform(df).orderBy("key").collect()] for m in (a, b))
    assert np.allclose(p, q, atol=1e-9)


@pytest.mark.parametrize("rows, classes, width, depth, split, leaf", [(900, 3, 4, None, 2, 1), (400, 2, 4, 6, 5, 2), (30, 2, 1, None, 2, 1), (0, 2, 2, 3, 2, 1)])
def test_trees_grown_by_rows_equal_those_grown_by_histograms(rows, classes, width, depth, split, leaf):
    """The same nodes in the same order, whichever way; columns with few bins, so that some nodes need a second draw of features."""
    g = np.random.default_rng(rows)
    bins = g.integers(0, [2 * 3**j for j in range(width)], (rows, width)).T.astype(np.uint8).copy()
    y = ((bins.sum(axis=0) // 9 + g.integers(0, 3, rows)) % classes).astype(np.int32)
    block = Block(bins, y, g.random(rows) + 0.5, g.integers(0, 2**63, rows).astype(np.uint64), np.zeros((rows, 0)))
    plan, levels = Bagging(classes, 5, depth, Gini(classes, split, leaf), max(1, width // 2), 7), int(bins.max(initial=0)) + 1
    for (a, v), (b, w) in zip(plan.some(Alone(block), range(5), levels, width), plan.alone(block, range(5), levels), strict=True):
        assert all((getattr(a, c) == getattr(b, c)).all() for c in ("feature", "bin", "left")) and (v == w).all()


def test_a_forest_over_many_blocks_runs_no_job_for_each_level(noisy, monkeypatch):
    """Trees without a depth limit on several blocks: whole trees in tasks; above the bound the job for each level gives the same ones."""
    def unused(*args):
        raise AssertionError("a job for each level")

    learner = large_forest(FEATURES, "y", trees=3, key="key", block_rows=300)
    with monkeypatch.context() as m:
        m.setattr(binned.Spread, "cuts", unused)
        a = learner.fit(noisy)
    monkeypatch.setattr(binned, "SHARED_BYTES", 0)
    b = learner.fit(noisy)
    for (s, v), (t, w) in zip(a.trees, b.trees, strict=True):
        assert (s.feature == t.feature).all() and (s.bin == t.bin).all() and (v == w).all()


def test_a_round_over_blocks_takes_one_job_for_each_level(spark, noisy):
    """Changes of the rows' state have no job of their own (but for checkpoints), and older blocks do not stay."""
    sc = spark.sparkContext
    learner = gbt(FEATURES, "y", rounds=12, depth=2, weighting=None, key="key", block_rows=300)
    table = learner._fit(noisy)[1]
    store = binned.Spread(table.blocks, table.count)
    held = len(sc._jsc.getPersistentRDDs())
    learner.make(3, 3).run(store, table.levels, 3)
    assert len(sc._jsc.getPersistentRDDs()) <= held + 2
    sc.setJobGroup("boosting", "rounds")
    try:
        learner.make(3, 3).run(store, table.levels, 3)
        jobs = sc.statusTracker().getJobIdsForGroup("boosting")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        store.close()
    assert len(jobs) <= 12 * 2 + 12  # before: one more for each round; checkpoints write in jobs of their own


def plain_tree(bins, y, weight, inside, features, rule, depth):
    """A classification tree by trying every cut; returns class shares of every row."""
    k = rule.classes
    out = np.zeros((len(y), k))

    def totals(rows):
        return np.append(np.bincount(y[rows], weights=weight[rows], minlength=k), inside[rows].sum())

    def fit(member, tree_node, level):
        rows = member[inside[member]]
        whole = totals(rows)
        best = (-1.0, None)
        if level < depth and whole[-1] >= max(rule.min_split, 2) and (whole[:-1] > 0).sum() > 1:
            order = features(tree_node)
            for f in sorted(order):
                for cut in range(bins[f].max()):
                    left, right = totals(rows[bins[f, rows] <= cut]), totals(rows[bins[f, rows] > cut])
                    if min(left[-1], right[-1]) < max(rule.min_leaf, 1):
                        continue
                    gain = max(0.0, sum((s[:-1] ** 2).sum() / s[:-1].sum() for s in (left, right)) - (whole[:-1] ** 2).sum() / whole[:-1].sum())
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, cut))
        if best[1] is None:
            out[member] = whole[:-1] / whole[:-1].sum()
            return None
        f, cut = best[1]
        return [(member[bins[f, member] <= cut]), (member[bins[f, member] > cut])]

    level, queue, made = 0, [(np.arange(len(y)), 0)], 1
    while queue:
        below = []
        for member, node in queue:
            sides = fit(member, node, level)
            if sides is not None:
                below += [(sides[0], made), (sides[1], made + 1)]
                made += 2
        queue, level = below, level + 1
    return out


def test_forest_and_out_of_bag_votes_equal_a_plain_version(noisy):
    """Every feature at every node, bags by hash: class shares of all trees, and the votes of those that left a row out."""
    learner = random_forest(FEATURES, "y", trees=6, depth=4, strategy="all", min_split=8, min_leaf=3, key="key", bins=12)
    model, votes = learner.out_of_bag(noisy)
    _, table = learner._fit(noisy)
    b = block_of(noisy, table, None)
    plan, total, seen = model.plan, np.zeros((len(b.y), 3)), np.zeros(len(b.y), dtype=bool)
    for t, (tree, values) in enumerate(model.trees):
        copies = plan.copies(b, t)
        weight = np.rint(b.w * copies * SCALE) / SCALE
        want = plain_tree(b.bins, b.y, weight, copies > 0, lambda _: range(3), plan.rule, 4)
        got = values[tree.assign(b.bins)]
        assert np.allclose(got, want, atol=1e-9), t
        total[copies == 0] += want[copies == 0]
        seen |= copies == 0
    cells = {(r["label"], r["prediction"]): r["n"] for r in votes.collect()}
    want = {(int(a), int(p)): int(((b.y == a) & (total.argmax(axis=1) == p) & seen).sum()) for a in range(3) for p in range(3)}
    assert cells == {k: n for k, n in want.items() if n}


def test_bags_follow_the_law_and_trees_differ(noisy):
    model, table = large_forest(FEATURES, "y", trees=50, key="key")._fit(noisy)
    b = block_of(noisy, table, None)
    copies = np.stack([model.plan.copies(b, t) for t in range(50)])
    assert abs(copies.mean() - 1) < 0.02 and abs((copies == 0).mean() - np.exp(-1)) < 0.01
    assert len({tuple(t.feature) for t, _ in model.trees}) > 45
    assert out_of_bag(random_forest(FEATURES, "y", trees=60, key="key"), noisy)["f1_macro"] > 0.45


def test_adaptive_rounds_equal_a_plain_version(noisy):
    learner = adaboost(FEATURES, "y", rounds=4, depth=2, min_split=5, min_leaf=2, key="key", bins=10)
    model, table = learner._fit(noisy)
    b = block_of(noisy, table, None)
    weight, rule = np.ones(len(b.y)), Gini(3, 5, 2)
    assert isinstance(model.plan, Adaptive) or model.plan.classes == 3
    for tree, guess, alpha in model.trees:
        want = plain_tree(b.bins, b.y, np.rint(b.w * weight * SCALE) / SCALE, np.ones(len(b.y), dtype=bool), lambda _: range(3), rule, 2).argmax(axis=1)
        got = guess[tree.assign(b.bins)]
        assert (got == want).mean() > 0.999
        miss = got != b.y
        error = weight[miss].sum() / weight.sum()
        assert alpha == pytest.approx(0.1 * (np.log((1 - error) / error) + np.log(2)), abs=1e-5)
        weight = weight * np.where(miss, np.exp(alpha), 1) / weight.mean()


def test_edge_tables(spark, noisy):
    for learner in (gbt(FEATURES, "y", rounds=2, key="key"), random_forest(FEATURES, "y", trees=3, key="key"), adaboost(FEATURES, "y", rounds=2, key="key")):
        one = learner.fit(noisy.where("y = 0").limit(9)).transform(noisy.limit(5))
        assert {r.prediction for r in one.collect()} == {0}
        none = learner.fit(noisy.limit(0)).transform(noisy.limit(5)).collect()
        assert len(none) == 5 and all(abs(sum(r.probability) - 1) < 1e-9 for r in none)
    vector = noisy.select("key", "y", F.array(*FEATURES).alias("x"))
    same = gbt("x", "y", rounds=2, weighting=None, key="key").fit(vector).transform(vector)
    apart = gbt(FEATURES, "y", rounds=2, weighting=None, key="key").fit(noisy).transform(noisy)
    assert sorted(map(str, same.select("key", "prediction").collect())) == sorted(map(str, apart.select("key", "prediction").collect()))
    assert evaluate(apart, "y")["accuracy"] > 0.45
