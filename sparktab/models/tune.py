"""Cross-validation and parameter search. Results are small tables of scores."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.operators.features import fit_scaler
from sparktab.operators.knn import class_votes, knn_join, literal
from sparktab.operators.metrics import evaluate
from sparktab.session import cached, side_by_side

SCHEMA = "param_id int, params string, fold int, f1 double, f1_macro double, accuracy double"


def cv_rows(build: Callable[[dict], object], grid: Sequence[dict], df: DataFrame, label: str, fold: str = "fold") -> list[tuple]:
    """Scores of every parameter set on every fold.

    The folds of one training part serve all parameter sets before the next
    part is read, so each part is cached once.
    """
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())
    rows = []
    for f in folds:
        train, held = cached(df.where(F.col(fold) != f)), cached(df.where(F.col(fold) == f))
        scored = side_by_side(lambda p: evaluate(build(p).fit(train).transform(held), label), grid)  # noqa: B023
        rows += [(i, json.dumps(p, sort_keys=True), f, s["f1"], s["f1_macro"], s["accuracy"]) for i, (p, s) in enumerate(zip(grid, scored))]
        train.unpersist()
        held.unpersist()
    return rows


def cv_report(build, grid: Sequence[dict], df: DataFrame, label: str, fold: str = "fold") -> DataFrame:
    """``(param_id, params, fold, f1, f1_macro, accuracy)``."""
    return df.sparkSession.createDataFrame(cv_rows(build, grid, df, label, fold), SCHEMA)


def cv_means(report: DataFrame, metric: str = "f1") -> DataFrame:
    """Mean score per parameter set, best first; the earlier set wins a tie."""
    means = report.groupBy("param_id", "params").agg(F.avg(metric).alias("mean_score"), F.avg("accuracy").alias("mean_accuracy"))
    return means.orderBy(F.desc("mean_score"), "param_id")


def best_fold(report: DataFrame, metric: str = "f1") -> DataFrame:
    """The single best fold over all parameter sets."""
    return report.orderBy(F.desc(metric), "param_id", "fold").limit(1)


def cross_val(learner, df: DataFrame, label: str, fold: str = "fold") -> DataFrame:
    """Fold scores of one recipe."""
    return cv_report(lambda _: learner, [{}], df, label, fold).drop("param_id", "params")


def grid_search(build, grid: Sequence[dict], df: DataFrame, label: str, metric: str = "f1", fold: str = "fold"):
    """Best parameters by mean fold score, the recipe refitted on all rows, and the report."""
    report = cv_report(build, grid, df, label, fold)
    best = grid[cv_means(report, metric).first()["param_id"]]
    return best, build(best).fit(df), report


def holdout_search(build, grid: Sequence[dict], train: DataFrame, valid: DataFrame, label: str, metric: str = "f1"):
    """One pass over the grid on a fixed split; the first best wins."""
    train, valid = cached(train), cached(valid)
    scores = [s[metric] for s in side_by_side(lambda p: evaluate(build(p).fit(train).transform(valid), label), grid)]
    train.unpersist()
    valid.unpersist()
    best = max(range(len(grid)), key=lambda i: (scores[i], -i))
    return grid[best], list(zip(grid, scores))


# Penalties and kernel widths of the radial search (5 x 5 = 25 combinations).
RBF_GRID = {"C": (1.0, 10.0, 50.0, 100.0, 200.0), "gamma": ("scale", 0.1, 0.5, 1.0, 2.0)}


def penalty_rows(build: Callable[[dict], object], outer: Sequence[dict], penalties: Sequence[float], df: DataFrame, label: str, fold: str = "fold") -> list[tuple]:
    """``cv_rows`` for the grid ``outer`` x ``C``: the recipes' ``fit_all`` solves all penalties of a setting in the same passes over its rows."""
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())
    rows = []
    for f in folds:
        train, held = cached(df.where(F.col(fold) != f)), cached(df.where(F.col(fold) == f))

        def scores(p: dict) -> list[dict]:
            return [evaluate(m.transform(held), label) for m in build(p).fit_all(train, penalties)]  # noqa: B023

        found = [(o | {"C": c}, s) for o, own in zip(outer, side_by_side(scores, outer)) for c, s in zip(penalties, own)]
        rows += [(i, json.dumps(p, sort_keys=True), f, s["f1"], s["f1_macro"], s["accuracy"]) for i, (p, s) in enumerate(found)]
        train.unpersist()
        held.unpersist()
    return rows


def penalty_search(
    build: Callable[[dict], object], outer: Sequence[dict], penalties: Sequence[float], df: DataFrame, label: str, metric: str = "f1_macro", fold: str = "fold",
) -> tuple[dict, DataFrame]:
    """The best setting by mean fold score (the first one on ties) and the report; ``build`` makes a recipe with ``fit_all``."""
    report = df.sparkSession.createDataFrame(penalty_rows(build, outer, penalties, df, label, fold), SCHEMA)
    best = cv_means(report, metric).first()["param_id"]
    return outer[best // len(penalties)] | {"C": penalties[best % len(penalties)]}, report


# The neighbour grid (5 x 2 x 2 x 2 = 40 combinations).
KNN_GRID = {
    "k": (7, 11, 15, 21, 31),
    "weights": ("uniform", "distance"),
    "metric": ("minkowski", "manhattan"),
    "p": (1, 2),
}


def knn_grid(
    df: DataFrame, key: str, features: Sequence[str], label: str, fold: str = "fold",
    ks: Sequence[int] = KNN_GRID["k"], weights: Sequence[str] = KNN_GRID["weights"],
    metrics: Sequence[str] = KNN_GRID["metric"], powers: Sequence[int] = KNN_GRID["p"],
    scale: str | None = "standard", positive=1, **options,
) -> DataFrame:
    """F1 and accuracy of every neighbour setting on every fold.

    One neighbour table per fold and distance, with the largest k, serves all
    settings; Manhattan and Minkowski with p = 1 are the same distance.
    """
    classes = [r[0] for r in df.select(label).distinct().orderBy(label).collect()]
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())
    names = f"array({', '.join(literal(c) for c in classes)})"
    settings = [(k, w) for k in ks for w in weights]
    used = sorted({1 if m == "manhattan" else p for m in metrics for p in powers})
    tables = []
    for f in folds:
        train, held = df.where(F.col(fold) != f), df.where(F.col(fold) == f)
        scaler = fit_scaler(train, features, scale)
        if scaler:
            train, held = scaler.transform(train), scaler.transform(held)
        for p in used:
            found = knn_join(train, held, key, features, max(ks), p, (label,), **options)
            shares = found.groupBy("qid").agg(*[F.expr(class_votes(label, classes, k, w)).alias(f"v{i}") for i, (k, w) in enumerate(settings)])
            guesses = ", ".join(f"element_at({names}, int(array_position(v{i}, array_max(v{i}))))" for i in range(len(settings)))
            votes = shares.selectExpr("qid", f"array({guesses}) AS guess")
            scored = votes.join(held.select(F.col(key).alias("qid"), F.col(label).alias("y")), "qid")
            tables.append(scored.select(F.lit(f).alias("fold"), F.lit(p).alias("p_used"), "y", F.posexplode("guess").alias("setting", "guess")))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    y, g = F.col("y") == F.lit(positive), F.col("guess") == F.lit(positive)
    tp, wrong = F.count_if(y & g), F.count_if(y != g)
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * tp, F.lit(2.0) * tp + wrong), F.lit(0.0))
    scores = out.groupBy("fold", "p_used", "setting").agg(f1.alias("f1"), F.avg((F.col("y") == F.col("guess")).cast("double")).alias("accuracy"))
    combos = [
        F.struct(F.lit(m).alias("metric"), F.lit(p).alias("p"), F.lit(1 if m == "manhattan" else p).alias("uses"))
        for m in metrics for p in powers
    ]
    wide = scores.select("*", F.explode(F.filter(F.array(*combos), lambda c: c["uses"] == F.col("p_used"))).alias("c"))
    k_of = F.get(F.array(*[F.lit(k) for k, _ in settings]), F.col("setting"))
    w_of = F.get(F.array(*[F.lit(w) for _, w in settings]), F.col("setting"))
    return wide.select(k_of.alias("k"), w_of.alias("weights"), "c.metric", "c.p", "fold", "f1", "accuracy")
