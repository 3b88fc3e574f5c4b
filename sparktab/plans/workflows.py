"""Whole jobs put together from the operators."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.models.ensemble import best_blend, blend_search, blend_search_classes, f1_weights, fit_all, pair_grid, score_all, select_best, simplex_grid, stack, triple_grid, vote
from sparktab.operators.clean import holdout_by_ids
from sparktab.operators.encode import LabelCoder
from sparktab.operators.features import FeatureModel, FeatureSpec
from sparktab.operators.metrics import classification_report, evaluate
from sparktab.operators.split import stratified_folds, train_test
from sparktab.session import cached
from sparktab.sources.tables import write_table


def preprocess(
    train: DataFrame, test: DataFrame, spec: FeatureSpec, save: str | None = None, fmt: str = "parquet"
) -> tuple[DataFrame, DataFrame, FeatureModel]:
    """Fit on train, transform both; optionally write both and the target."""
    model = spec.fit(train)
    a, b = model.transform(train), model.transform(test)
    if save:
        drop = [spec.target] if spec.target else []
        write_table(a.drop(*drop), f"{save}/train_features", fmt)
        write_table(b.drop(*drop), f"{save}/test_features", fmt)
        if spec.target and spec.target in train.columns:
            write_table(train.select(spec.key, spec.target), f"{save}/train_target", fmt)
    return a, b, model


def evaluate_holdout(
    df: DataFrame, ids: DataFrame, key: str, label: str, learner, coder: LabelCoder | None = None
) -> tuple[DataFrame, DataFrame, float]:
    """Train without the listed rows, score them, decode, report.

    Returns the scored rows, the report and F1 (macro beyond two classes).
    """
    train, held = holdout_by_ids(df, ids, key)
    scored = learner.fit(train).transform(held)
    f1 = evaluate(scored, label)["f1"]
    if coder is None:
        return scored, classification_report(scored, label), f1
    named = coder.decode(coder.decode(scored, label, "true_class"), "prediction", "predicted_class")
    return named, classification_report(named, "true_class", "predicted_class"), f1


def train_and_validate(df: DataFrame, key: str, label: str, learner, frac: float = 0.2, seed: int = 42):
    """Stratified hold-out, fit, report, then refit on all rows."""
    train, valid = train_test(df, key, label, frac, seed)
    report = classification_report(learner.fit(train).transform(valid), label)
    return learner.fit(df), report


@dataclass
class EnsembleChoice:
    """The winning combination and everything needed to apply it."""

    method: str
    scores: DataFrame
    models: dict
    weights: list[float] | None
    threshold: float
    stacked: object | None = None
    classes: int = 2

    def transform(self, df: DataFrame, classes: int | None = None) -> DataFrame:
        if self.stacked is not None:
            return self.stacked.transform(df)
        classes = classes or self.classes
        scored = score_all(self.models, df)
        names = [f"probability_{m}" for m in self.models]
        shares = vote(scored, names, classes, "soft", self.weights)
        if classes > 2:
            return shares.select(*df.columns, "prediction", F.col("prediction_shares").alias("probability"))
        guess = (F.col("prediction_shares")[1] > F.lit(self.threshold)).cast("int")
        return shares.select(*df.columns, guess.alias("prediction"), F.col("prediction_shares").alias("probability"))


def choose_ensemble(
    bases: Mapping[str, object], df: DataFrame, key: str, label: str, classes: int = 2,
    frac: float = 0.2, seed: int = 42, stacking_folds: int | None = 5, grid: list | None = None,
) -> EnsembleChoice:
    """Try equal votes, F1-weighted votes, stacking and blending on a hold-out;
    refit the winner on all rows.

    Base models are trained once on the training part and their scores reused.
    Blending searches weights and thresholds for two classes, weights and the highest blended share for more.
    """
    train, valid = train_test(df, key, label, frac, seed)
    train, valid = cached(train), cached(valid)
    models = fit_all(bases, train)
    scored = cached(score_all(models, valid))
    probs = [f"probability_{m}" for m in bases]
    singles = [evaluate(scored, label, f"prediction_{m}")["f1"] for m in bases]
    weights = f1_weights(singles)
    tried = [
        ("equal votes", evaluate(vote(scored, probs, classes, "soft", None, "vote"), label, "vote")["f1"], None, 0.5),
        ("weighted votes", evaluate(vote(scored, probs, classes, "soft", weights, "vote"), label, "vote")["f1"], weights, 0.5),
    ]
    stacked = None
    if stacking_folds:
        folded = stratified_folds(train, key, label, stacking_folds, shuffle=False)
        stacked = stack(bases, folded, label, classes)
        tried.append(("stacking", evaluate(stacked.transform(valid), label)["f1"], None, 0.5))
    if classes == 2:
        plan = grid or (pair_grid() if len(bases) == 2 else triple_grid() if len(bases) == 3 else [(w, 0.5) for w in simplex_grid(len(bases))])
        ones = scored.withColumns({f"p_{m}": F.col(f"probability_{m}")[1] for m in bases})
        top = best_blend(blend_search(ones, [f"p_{m}" for m in bases], label, plan)).first()
        tried.append(("blending", top["f1"], [top[f"w{i}"] for i in range(1, len(bases) + 1)], top["threshold"]))
    else:
        top = best_blend(blend_search_classes(scored, probs, label, classes, grid or simplex_grid(len(bases)))).first()
        tried.append(("blending", top["f1"], list(top["weights"]), 0.5))
    rows = [(i, name, float(f1)) for i, (name, f1, _, _) in enumerate(tried)]
    table = df.sparkSession.createDataFrame(rows, "ordinal int, method string, f1 double")
    winner = tried[select_best(table).first()["ordinal"]]
    for part in (train, valid, scored):
        part.unpersist()
    if winner[0] == "stacking":
        folded = stratified_folds(df, key, label, stacking_folds, shuffle=False)
        return EnsembleChoice(winner[0], table, {}, None, 0.5, stack(bases, folded, label, classes), classes)
    return EnsembleChoice(winner[0], table, fit_all(bases, df), winner[2], winner[3], classes=classes)


def score_grid(model, df: DataFrame, x: str, y: str, step: float = 2.0) -> DataFrame:
    """Predictions over a regular grid one unit wider than the data in both measures."""
    low_x, high_x, low_y, high_y = df.agg(F.min(x) - 1, F.max(x) + 1, F.min(y) - 1, F.max(y) + 1).first()
    spark = df.sparkSession

    def count(low: float, high: float) -> int:
        return max(0, int(-(-(high - low) // step)))

    nx, ny = count(low_x, high_x), count(low_y, high_y)
    points = spark.range(nx * ny).select(
        (F.lit(float(low_x)) + F.col("id") % nx * F.lit(float(step))).alias(x),
        (F.lit(float(low_y)) + F.floor(F.col("id") / nx) * F.lit(float(step))).alias(y),
    )
    return model.transform(points)
