"""Gaussian naive Bayes: one grouped aggregation to fit, one projection to score."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.functions.expressions import best_index, finite, name, num
from sparktab.operators.moments import FEW_COLUMNS, class_moments

SMOOTHING = 1e-9  # fixed value: share of the largest variance added to every variance


@dataclass(frozen=True)
class GaussianNBModel:
    features: tuple[str, ...]
    classes: tuple
    prior: dict
    mean: dict
    var: dict

    def joint(self) -> list:
        """Joint log-likelihood of each class as a column."""
        out = []
        for c in self.classes:
            const = math.log(self.prior[c])
            const -= 0.5 * sum(math.log(2.0 * math.pi * v) for v in self.var[c])
            gaps = [
                f"pow(double({name(f)}) - {num(m)}, 2) / {num(2.0 * v)}"
                for f, m, v in zip(self.features, self.mean[c], self.var[c])
            ]
            out.append(F.expr(f"{num(const)} - ({' + '.join(gaps)})"))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        logs = df.withColumn("__log", F.array(*self.joint()))
        top = F.array_max("__log")
        logs = logs.withColumn("__e", F.transform("__log", lambda v: F.exp(v - top)))
        total = F.aggregate("__e", F.lit(0.0), lambda a, v: a + v)
        names = F.array(*[F.lit(c) for c in self.classes])
        return logs.select(
            *df.columns, F.get(names, best_index(F.col("__log"))).alias("prediction"),
            F.transform("__e", lambda v: v / total).alias("probability"),
        )


@dataclass(frozen=True)
class GaussianNB:
    features: tuple[str, ...]
    label: str
    smoothing: float = SMOOTHING

    def fit(self, df: DataFrame) -> GaussianNBModel:
        """Class means and population variances; the overall variance sets the smoothing.

        The overall variance follows from the class rows, so one pass is enough.
        """
        stats = self._class_stats(df)
        classes = tuple(sorted(stats))
        rows = {c: stats[c][0] for c in classes}
        total = sum(rows.values())
        largest = 0.0
        for i in range(len(self.features)):
            mean = sum(rows[c] * stats[c][1][i] for c in classes) / total
            spread = sum(rows[c] * (stats[c][2][i] + (stats[c][1][i] - mean) ** 2) for c in classes)
            largest = max(largest, spread / total)
        eps = self.smoothing * largest
        return GaussianNBModel(
            tuple(self.features), classes,
            {c: rows[c] / total for c in classes},
            {c: stats[c][1] for c in classes},
            {c: [v + eps for v in stats[c][2]] for c in classes},
        )

    def _class_stats(self, df: DataFrame) -> dict:
        """``{class: (rows, means, population variances)}``."""
        if len(self.features) > FEW_COLUMNS:
            found = class_moments(df, list(self.features), self.label)
            pick = {c: [m[f] for f in self.features] for c, m in found.items()}
            return {c: (ms[0].rows, [m.mean for m in ms], [m.m2 / m.n for m in ms]) for c, ms in pick.items()}
        aggs = [F.count("*").alias("n")]
        for i, c in enumerate(self.features):
            x = finite(F.col(f"`{c}`"))  # as beyond a few columns
            aggs += [F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
        rows = df.where(F.col(self.label).isNotNull()).groupBy(self.label).agg(*aggs).collect()  # one per class
        pick = range(len(self.features))
        return {r[0]: (r["n"], [r[f"m{i}"] for i in pick], [r[f"v{i}"] for i in pick]) for r in rows}


def gaussian_nb(df: DataFrame, features: Sequence[str], label: str) -> GaussianNBModel:
    return GaussianNB(tuple(features), label).fit(df)
