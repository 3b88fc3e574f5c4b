"""Voting, stacking and blending.

Models score the same DataFrame one after another, so their predictions are
columns of one row and combining them needs no join.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.functions.expressions import best_index, name, num, safe_share
from sparktab.models.linear import logreg
from sparktab.session import cached, ensure_checkpoint_dir, side_by_side


def fit_all(bases: Mapping[str, object], df: DataFrame) -> dict:
    """All recipes fitted on the same rows, a few at once. The rows are cached meanwhile; a table that the caller keeps stays kept."""
    ensure_checkpoint_dir(df.sparkSession)
    kept = df.storageLevel.useMemory or df.storageLevel.useDisk
    whole = df if kept else cached(df)
    models = dict(zip(bases, side_by_side(lambda learner: learner.fit(whole), list(bases.values()))))
    if not kept:
        whole.unpersist()
    return models


def score_all(models: Mapping[str, object], df: DataFrame) -> DataFrame:
    """Add ``prediction_<name>`` and ``probability_<name>`` for every model."""
    for name, model in models.items():
        df = model.transform(df).withColumnsRenamed(
            {"prediction": f"prediction_{name}", "probability": f"probability_{name}"}
        )
    return df


def f1_weights(scores: Sequence[float]) -> list[float]:
    """Squared shares of the F1 scores, normalised; equal if all are zero."""
    total = sum(scores)
    if total <= 0:
        return [1.0 / len(scores)] * len(scores)
    squares = [(s / total) ** 2 for s in scores]
    return [s / sum(squares) for s in squares]


def f1_weight_table(scores: DataFrame) -> DataFrame:
    """The same on a score table ``(model, f1)``, as columns."""
    total = scores.agg(F.sum("f1")).scalar()
    shares = scores.withColumn("sq", F.try_divide(F.col("f1"), total) ** 2)
    norm = shares.agg(F.sum("sq")).scalar()
    count = scores.agg(F.count("*")).scalar()
    return shares.select("model", "f1", F.coalesce(F.try_divide(F.col("sq"), norm), F.lit(1.0) / count).alias("weight"))


def _mix(parts: Sequence[Column], weights: Sequence[float] | None) -> Column:
    weights = [1.0] * len(parts) if weights is None else list(weights)
    total = sum(weights)
    terms = [c * F.lit(float(w)) for c, w in zip(parts, weights)]
    return sum(terms[1:], terms[0]) / F.lit(float(total))


def vote(
    df: DataFrame, columns: Sequence[str], classes: int, mode: str = "soft",
    weights: Sequence[float] | None = None, out: str = "prediction",
) -> DataFrame:
    """Soft vote over probability arrays or hard vote over predicted classes 0..K-1.

    The first class wins a tie.
    """
    if mode == "soft":
        scores = [_mix([F.get(F.col(c), F.lit(i)) for c in columns], weights) for i in range(classes)]
    else:
        scores = [_mix([(F.col(c) == i).cast("double") for c in columns], weights) for i in range(classes)]
    return df.withColumn(f"{out}_shares", F.array(*scores)).withColumn(out, best_index(F.col(f"{out}_shares")))


class StackModel:
    """Base models and the logistic model on their probabilities."""

    def __init__(self, models: dict, meta, classes: int):
        self.models, self.meta, self.classes = models, meta, classes

    def transform(self, df: DataFrame) -> DataFrame:
        scored = meta_features(score_all(self.models, df), list(self.models), self.classes)
        return self.meta.transform(scored).select(*df.columns, "prediction", "probability")


def meta_names(models: Sequence[str], classes: int) -> list[str]:
    """One column per model for two classes, one per model and class otherwise."""
    return [f"meta_{m}_{c}" for m in models for c in ([1] if classes == 2 else range(classes))]


def meta_features(df: DataFrame, models: Sequence[str], classes: int) -> DataFrame:
    cells = {
        f"meta_{m}_{c}": F.get(F.col(f"probability_{m}"), F.lit(c)) for m in models for c in ([1] if classes == 2 else range(classes))
    }
    return df.withColumns(cells)


def out_of_fold(bases: Mapping[str, object], df: DataFrame, classes: int, fold: str = "fold") -> DataFrame:
    """Each row scored by models that did not see its fold. The fits wait for nothing of each other, so a few share the cluster."""
    ensure_checkpoint_dir(df.sparkSession)
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())

    def fitted(f) -> dict:
        train = cached(df.where(F.col(fold) != f))
        models = {name: learner.fit(train) for name, learner in bases.items()}
        train.unpersist()
        return models

    parts = None
    for f, models in zip(folds, side_by_side(fitted, folds)):
        scored = meta_features(score_all(models, df.where(F.col(fold) == f)), list(bases), classes)
        parts = scored if parts is None else parts.unionByName(scored)
    return parts


def stack(bases: Mapping[str, object], df: DataFrame, label: str, classes: int, C: float = 1.0, fold: str = "fold") -> StackModel:
    """Balanced logistic regression on out-of-fold probabilities; bases refit on all rows."""
    names = meta_names(list(bases), classes)
    rows = cached(out_of_fold(bases, df, classes, fold).select(label, *names))
    meta = logreg(names, label, C, scale=None).fit(rows)
    rows.unpersist()
    return StackModel(fit_all(bases, df), meta, classes)


# Blend grids as (start, stop, step) of a half-open range.
PAIR_FIVE_THRESHOLDS = {"weights": (0.2, 0.9, 0.05), "thresholds": [0.4, 0.45, 0.5, 0.55, 0.6]}
PAIR_FINE_THRESHOLDS = {"weights": (0.2, 0.8, 0.05), "thresholds": (0.4, 0.6, 0.02)}
TRIPLE = {"first": (0.2, 0.9, 0.1), "second": (0.1, 0.8, 0.1)}


def _steps(values) -> list[float]:
    return [float(v) for v in (np.arange(*values) if isinstance(values, tuple) else values)]


def pair_grid(weights=PAIR_FINE_THRESHOLDS["weights"], thresholds=PAIR_FINE_THRESHOLDS["thresholds"]) -> list[tuple]:
    """Combinations ``((w1, w2), t)`` in search order."""
    return [((w, 1.0 - w), t) for w in _steps(weights) for t in _steps(thresholds)]


def triple_grid(first=TRIPLE["first"], second=TRIPLE["second"], threshold: float = 0.5) -> list[tuple]:
    """Combinations on the simplex whose third weight stays positive."""
    pairs = [(a, b, 1.0 - a - b) for a in _steps(first) for b in _steps(second)]
    return [(w, threshold) for w in pairs if w[2] > 0]


def simplex_grid(models: int, parts: int = 10) -> list[tuple[float, ...]]:
    """All weights that are positive multiples of ``1 / parts`` and sum to one, ascending; equal weights if there are too many models."""
    if models > parts:
        return [tuple([1.0 / models] * models)]
    cuts = combinations(range(1, parts), models - 1)
    return [tuple((b - a) / parts for a, b in zip((0, *c), (*c, parts))) for c in cuts]


def blend_search_classes(df: DataFrame, probabilities: Sequence[str], label: str, classes: int, grid: Sequence[Sequence[float]]) -> DataFrame:
    """Macro F1 of every blend of probability arrays, the class with the highest blended share being the guess (the first on ties).

    One pass as in ``blend_search``, for any number of models and of classes 0..K-1; tasks hand on one row per combination and class.
    A row without all its shares is a miss, one without a label is left out; classes neither seen nor guessed do not count.
    Returns ``(ordinal, weights, f1)``.
    """
    cols = [f"s{j}" for j in range(len(probabilities))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tp, g, p = np.zeros((len(grid), classes), dtype="int64"), np.zeros((len(grid), classes), dtype="int64"), np.zeros(classes, dtype="int64")
        for batch in batches:
            y = batch.column(0).to_numpy()
            p += np.bincount(y, minlength=classes)
            known = batch.column(1).to_numpy(zero_copy_only=False)
            if not known.any():
                continue
            y, kept = y[known], batch.filter(pa.array(known))
            parts = [kept.column(2 + j).flatten().to_numpy(zero_copy_only=False).reshape(len(y), classes) for j in range(len(cols))]
            for i, w in enumerate(grid):
                mixed = w[0] * parts[0]
                for weight, part in zip(w[1:], parts[1:]):
                    mixed = mixed + weight * part
                guess = mixed.argmax(axis=1)
                g[i] += np.bincount(guess, minlength=classes)
                tp[i] += np.bincount(guess[guess == y], minlength=classes)
        ordinal, c = np.divmod(np.arange(len(grid) * classes, dtype="int32"), classes)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (ordinal, c, tp.ravel(), g.ravel(), np.tile(p, len(grid)))], ["ordinal", "c", "tp", "g", "p"])

    complete = [F.coalesce((F.size(F.col(s)) == classes) & ~F.exists(F.col(s), lambda v: v.isNull() | F.isnan(v)), F.lit(False)) for s in probabilities]
    rows = df.where(F.col(label).isNotNull()).select(
        F.col(label).cast("int").alias("y"), reduce(lambda a, b: a & b, complete).alias("known"), *[F.col(s).cast("array<double>").alias(c) for s, c in zip(probabilities, cols)]
    )
    counts = rows.mapInArrow(count, "ordinal int, c int, tp bigint, g bigint, p bigint").groupBy("ordinal", "c").agg(*[F.sum(v).alias(v) for v in ("tp", "g", "p")])
    f1 = F.avg(F.when(F.col("g") + F.col("p") > 0, F.lit(2.0) * F.col("tp") / (F.col("g") + F.col("p"))))
    scores = counts.groupBy("ordinal").agg(F.coalesce(f1, F.lit(0.0)).alias("f1"))
    plan = df.sparkSession.createDataFrame([(i, [float(v) for v in w]) for i, w in enumerate(grid)], "ordinal int, weights array<double>")
    return plan.join(scores, "ordinal").select("ordinal", "weights", "f1")


def _blend(scores: Sequence[str], weights: Sequence[float]) -> str:
    return " + ".join(f"{num(w)} * {name(s)}" for s, w in zip(scores, weights))


def blend_search(df: DataFrame, scores: Sequence[str], label: str, grid: Sequence[tuple]) -> DataFrame:
    """F1 of every blend of the grid from one pass over the table.

    Tasks count the hits of all combinations batch by batch and hand on one
    short row per combination. Returns ``(ordinal, w1.., threshold, f1)``.
    """
    cols = [f"s{j}" for j in range(len(scores))]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tp, g, p = np.zeros(len(grid), dtype="int64"), np.zeros(len(grid), dtype="int64"), 0
        for batch in batches:
            p += int(batch["y"].sum())
            y, parts = batch["y"].to_numpy(dtype=bool), [batch[c].to_numpy(dtype="float64") for c in cols]
            for i, (w, t) in enumerate(grid):
                mixed = w[0] * parts[0]
                for weight, part in zip(w[1:], parts[1:]):
                    mixed = mixed + weight * part
                guess = mixed > t
                g[i] += guess.sum()
                tp[i] += (guess & y).sum()
        yield pd.DataFrame({"ordinal": np.arange(len(grid), dtype="int32"), "tp": tp, "g": g, "p": p})

    rows = df.select(F.coalesce(F.col(label) == 1, F.lit(False)).alias("y"), *[F.col(s).cast("double").alias(c) for s, c in zip(scores, cols)])
    counts = rows.mapInPandas(count, "ordinal int, tp bigint, g bigint, p bigint").groupBy("ordinal").agg(*[F.sum(c).alias(c) for c in ("tp", "g", "p")])
    parts = [
        (i, *[float(v) for v in w], float(t)) for i, (w, t) in enumerate(grid)
    ]
    names = ["ordinal", *[f"w{j}" for j in range(1, len(scores) + 1)], "threshold"]
    types = ["int", *["double"] * (len(scores) + 1)]
    plan = df.sparkSession.createDataFrame(parts, ", ".join(f"{n} {t}" for n, t in zip(names, types)))
    f1 = safe_share(F.lit(2) * F.col("tp"), F.col("g") + F.col("p"))
    return plan.join(counts, "ordinal").select(*names, f1.alias("f1"))


def best_blend(results: DataFrame) -> DataFrame:
    """The blend with the highest F1; the first one on ties."""
    return results.orderBy(F.desc("f1"), "ordinal").limit(1)


def blend_predict(df: DataFrame, scores: Sequence[str], weights: Sequence[float], threshold: float, out: str = "prediction") -> DataFrame:
    return df.withColumn(out, F.expr(f"int({_blend(scores, weights)} > {num(threshold)})"))


def select_best(results: DataFrame) -> DataFrame:
    """The method with the highest F1 of ``(ordinal, method, f1)``; the first one on ties."""
    return results.orderBy(F.desc("f1"), "ordinal").limit(1)
