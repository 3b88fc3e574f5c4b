"""Probabilities for margin models: a sigmoid for each margin, fitted on margins of rows that the model did not see, and pairwise coupling.

The sigmoids follow Platt (1999) with the smoothed targets of Lin, Lin & Weng (2007); for more than two classes the pair probabilities are coupled by
the second method of Wu, Lin & Weng (2004), one small linear system for each row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.functions.expressions import name
from sparktab.models.margin import STEPS, Problem, add_up, newton
from sparktab.operators.split import stratified_folds
from sparktab.session import cached


def sigmoid_sums(f: np.ndarray, t: np.ndarray, w: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Cross-entropies at ``w + s * step`` for all ``STEPS``, then gradient and second derivatives at the full step."""
    x = np.column_stack([f, np.ones(len(f))])
    losses = []
    for s in STEPS:
        z = x @ (w + s * step)
        losses.append(float((np.logaddexp(0.0, z) - t * z).sum()))
    p = 1.0 / (1.0 + np.exp(-np.clip(x @ (w + step), -700, 700)))
    return np.concatenate([losses, (p - t) @ x, ((x.T * (p * (1 - p))) @ x).ravel()])


def sigmoids(rows: DataFrame, problems: Sequence[Problem], max_iter: int = 50, tol: float = 1e-8) -> np.ndarray:
    """``(slope, intercept)`` for each problem from ``rows(margins, y)``; a slope is never negative, without signal it is zero."""
    counts = {int(r[0]): r[1] for r in rows.groupBy("y").count().collect()}
    n, k = sum(counts.values()), len(problems)
    sides = [(counts.get(a, 0), n - counts.get(a, 0) if b is None else counts.get(b, 0)) for a, b in problems]
    targets = [((up + 1.0) / (up + 2.0), 1.0 / (down + 2.0)) for up, down in sides]

    def passes(w: np.ndarray, step: np.ndarray, some: np.ndarray) -> np.ndarray:
        def sums(batch: pa.RecordBatch) -> np.ndarray:
            f = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, k)
            y = batch.column(1).to_numpy()
            out = np.zeros((len(some), len(STEPS) + 6))
            for i, j in enumerate(some):
                a, b = problems[j]
                part = slice(None) if b is None else (y == a) | (y == b)
                out[i] = sigmoid_sums(f[part, j], np.where(y[part] == a, *targets[j]), w[i], step[i])
            return out.ravel()

        return add_up(rows, len(some) * (len(STEPS) + 6), sums).reshape(len(some), -1)

    start = np.array([[0.0, np.log((up + 1.0) / (down + 1.0))] for up, down in sides])
    lines = newton(passes, start, np.ones(k), 1e-9, max_iter, tol)
    return np.where(lines[:, :1] > 0, lines, start)


def coupled(pairs: np.ndarray, problems: Sequence[tuple[int, int]], classes: int) -> np.ndarray:
    """Class probabilities (rows, classes) that fit the pair probabilities (rows, problems) best; ``pairs`` are those of the first class."""
    n = len(pairs)
    r = np.zeros((n, classes, classes))
    for j, (a, b) in enumerate(problems):
        r[:, a, b], r[:, b, a] = pairs[:, j], 1.0 - pairs[:, j]
    system = np.zeros((n, classes + 1, classes + 1))
    system[:, :classes, :classes] = -r.transpose(0, 2, 1) * r
    at = np.arange(classes)
    system[:, at, at] = (r * r).sum(axis=1)
    system[:, classes, :classes] = system[:, :classes, classes] = 1.0
    right = np.zeros((n, classes + 1, 1))
    right[:, classes] = 1.0
    p = np.clip(np.linalg.solve(system, right)[:, :classes, 0], 0.0, None)
    return p / p.sum(axis=1, keepdims=True)


@dataclass
class CalibratedModel:
    """A margin model and the sigmoids of its margins. Rows without margins have no probabilities."""

    model: object
    lines: np.ndarray

    def transform(self, df: DataFrame) -> DataFrame:
        lines, problems, classes = self.lines, self.model.problems, self.model.classes

        @F.pandas_udf("array<double>")
        def shares(raw: pd.Series) -> pd.Series:
            known = raw.map(lambda v: v is not None and all(x is not None for x in v)).to_numpy(dtype=bool)
            out = np.full(len(raw), None, dtype=object)
            if known.any():
                f = np.array(raw[known].tolist(), dtype="float64")
                p = 1.0 / (1.0 + np.exp(-np.clip(f * lines[:, 0] + lines[:, 1], -30, 30)))
                if classes == 2:
                    p = np.column_stack([1.0 - p[:, 0], p[:, 0]])
                elif problems[0][1] is None:
                    p = p / p.sum(axis=1, keepdims=True)
                else:
                    p = coupled(p, problems, classes)
                for i, row in zip(np.flatnonzero(known), p):
                    out[i] = row.tolist()
            return pd.Series(out)

        out = self.model.margins(df, "__raw")
        return out.select(*[F.col(name(c)) for c in df.columns], self.model.guess(F.col("__raw")).alias("prediction"), shares("__raw").alias("probability"))


@dataclass(frozen=True)
class Calibrated:
    """Recipe: the margin recipe ``learner`` (with ``fit_folds``) on all rows, and sigmoids on the margins of models that left a row's fold out.

    Folds are stratified and go by a hash of the row's features, so equal rows share a fold and no key is needed.
    """

    learner: object
    features: tuple[str, ...] | str
    label: str
    folds: int = 5

    def fit(self, df: DataFrame) -> CalibratedModel:
        names = [self.features] if isinstance(self.features, str) else list(self.features)
        df = df.where(F.col(name(self.label)).isNotNull()).select(*map(name, names), name(self.label))
        keyed = df.withColumn("__row", F.xxhash64(*[F.col(name(c)) for c in names]))
        folded = stratified_folds(keyed, "__row", self.label, self.folds, out="__fold")

        def lines(held: DataFrame, problems: Sequence[Problem]) -> np.ndarray:
            rows = cached(held.where(~F.exists("margins", F.isnan)))
            try:
                return sigmoids(rows, problems)
            finally:
                rows.unpersist()

        return CalibratedModel(*self.learner.fit_folds(folded, "__fold", self.folds, lines))
