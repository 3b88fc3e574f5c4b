"""Kernel SVM by an explicit feature map and a distributed linear solver, so that cost grows with rows, not with pairs of rows.

- ``poly``: the weighted monomials of ``(gamma x.y + coef0)^degree``, whose inner products are the kernel itself; beyond ``max_monomials`` of them
  (a matter of columns, not rows) a tensor sketch of ``n_components`` numbers (Pham & Pagh, 2013).
- ``rbf`` and ``sigmoid``: kernel values at ``n_components`` landmarks, whitened by the landmarks' own kernel matrix (Nystroem). Landmarks are drawn by
  their ridge leverage from a bounded set of different rows; with no more different rows than landmarks the map is exact.
- ``rbf`` with ``approximation="fourier"``: random Fourier features (Rahimi & Recht, 2007), without landmarks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from itertools import combinations_with_replacement
from math import comb, factorial, prod

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.functions.expressions import finite, name
from sparktab.models.calibrate import Calibrated
from sparktab.models.margin import MarginModel, SquaredHinge
from sparktab.operators.features import ScalerModel, fit_scaler
from sparktab.session import cached

MAP = "__map"


def gamma_scale(df: DataFrame, features: Sequence[str], scaler: ScalerModel | None) -> float:
    """``1 / (d * variance of all entries)``, from per-column sums in one pass."""
    aggs = []
    for i, c in enumerate(features):
        x = finite(scaler.value(c) if scaler else F.col(f"`{c}`"))
        aggs += [F.avg(x).alias(f"m{i}"), F.avg(x * x).alias(f"q{i}")]
    row = df.agg(*aggs).first()
    d = len(features)
    mean = sum(row[f"m{i}"] or 0.0 for i in range(d)) / d
    var = sum(row[f"q{i}"] or 0.0 for i in range(d)) / d - mean**2
    return 1.0 / (d * var) if var > 0 else 1.0


@dataclass(frozen=True)
class Kernel:
    kind: str
    gamma: float
    degree: int = 3
    coef0: float = 0.0

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if self.kind == "rbf":
            return np.exp(-self.gamma * np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0.0))
        inner = self.gamma * (a @ b.T) + self.coef0
        return inner**self.degree if self.kind == "poly" else np.tanh(inner)


class Fourier:
    """``sqrt(2/D) cos(Wx + b)`` with W ~ N(0, 2 gamma); inner products approach the RBF kernel."""

    def __init__(self, d: int, gamma: float, size: int, seed: int):
        rng = np.random.default_rng(seed)
        self.size, self.W, self.b = size, rng.normal(scale=np.sqrt(2.0 * gamma), size=(d, size)), rng.uniform(0.0, 2.0 * np.pi, size)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(2.0 / self.size) * np.cos(x @ self.W + self.b)


def monomial_count(d: int, degree: int, coef0: float) -> int:
    return comb(d + degree, degree) if coef0 else comb(d + degree - 1, degree)


class Monomials:
    """All products of columns that the expanded kernel holds, each times the root of its coefficient."""

    def __init__(self, d: int, kernel: Kernel):
        if kernel.coef0 < 0 or kernel.gamma < 0:
            raise ValueError("a polynomial kernel needs gamma >= 0 and coef0 >= 0")
        sizes = range(kernel.degree + 1) if kernel.coef0 else [kernel.degree]
        self.terms = [list(t) for size in sizes for t in combinations_with_replacement(range(d), size)]
        self.roots = []
        for t in self.terms:
            rest = kernel.degree - len(t)
            ways = factorial(kernel.degree) // (factorial(rest) * prod(factorial(t.count(c)) for c in set(t)))
            self.roots.append((ways * kernel.gamma ** len(t) * kernel.coef0**rest) ** 0.5)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([root * x[:, t].prod(axis=1) for t, root in zip(self.terms, self.roots)])


class TensorSketch:
    """``size`` numbers whose inner products have the polynomial kernel as their mean: convolved count sketches of the columns."""

    def __init__(self, d: int, kernel: Kernel, size: int, seed: int):
        rng = np.random.default_rng(seed)
        self.kernel, self.size, self.tables = kernel, size, []
        for _ in range(kernel.degree):
            table = np.zeros((d + 1, size))
            table[np.arange(d + 1), rng.integers(size, size=d + 1)] = rng.choice([-1.0, 1.0], d + 1)
            self.tables.append(table)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.column_stack([self.kernel.gamma**0.5 * x, np.full(len(x), self.kernel.coef0**0.5)])
        return np.fft.irfft(np.prod([np.fft.rfft(z @ t, axis=1) for t in self.tables], axis=0), n=self.size, axis=1)


class Landmarks:
    """Kernel values at landmarks, whitened. ``error`` is the mean absolute error of the kernel over the candidates."""

    def __init__(self, candidates: np.ndarray, kernel: Kernel, size: int, seed: int):
        K = kernel(candidates, candidates)
        chosen = np.arange(len(candidates))
        if len(candidates) > size:
            ridge = 1e-4 * max(1e-12, np.abs(np.diag(K)).mean())
            values, vectors = np.linalg.eigh(K)
            shares = np.abs(values) / (np.abs(values) + ridge * len(K))
            leverage = np.clip((vectors**2) @ shares, 1e-12, None)
            order = np.log(leverage) + np.random.default_rng(seed).gumbel(size=len(K))
            chosen = np.sort(np.argsort(-order, kind="stable")[:size])
        self.kernel, self.points = kernel, candidates[chosen]
        values, vectors = np.linalg.eigh(K[np.ix_(chosen, chosen)])
        keep = values > max(1e-12, 1e-10 * values.max(initial=0.0))  # a sigmoid's negative part is no inner product
        self.whiten = vectors[:, keep] / np.sqrt(values[keep])
        z = self(candidates)
        self.error = float(np.abs(z @ z.T - K).mean()) if len(K) else 0.0

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.kernel(x, self.points) @ self.whiten


def mapped(df: DataFrame, x: Column, f: object, out: str = MAP) -> DataFrame:
    """``df`` with the map ``f`` of the array ``x``; null where an entry is missing or infinite."""

    @F.pandas_udf("array<double>")
    def project(x: pd.Series) -> pd.Series:
        known = x.map(lambda v: v is not None and all(e is not None and np.isfinite(e) for e in v)).to_numpy(dtype=bool)
        z = np.full(len(x), None, dtype=object)
        if known.any():
            for i, row in zip(np.flatnonzero(known), f(np.array(x[known].tolist(), dtype="float64"))):
                z[i] = row
        return pd.Series(z)

    return df.withColumn(out, project(x))


def candidates_of(df: DataFrame, x: Column, d: int, limit: int, seed: int) -> np.ndarray:
    """At most ``limit`` different finite rows, those of the least hash. Rows are first thinned by the hash to a few times as many, so
    that neither frequent rows nor the size of the table reach one task."""
    rows = df.select(x.alias("x")).where(F.size("x") == d).where(F.forall("x", lambda v: finite(v).isNotNull())).withColumn("h", F.xxhash64(F.lit(seed), "x"))
    total = rows.agg(F.approx_count_distinct("h")).first()[0]
    if total > 4 * limit:
        rows = rows.where(F.pmod("h", F.lit(1 << 20)) < F.lit(int((1 << 20) * 4 * limit / total) + 1))
    found = rows.dropDuplicates(["h"]).orderBy("h").limit(limit).collect()  # bounded by ``limit``
    return np.array([r["x"] for r in found], dtype="float64").reshape(-1, d)


@dataclass
class KernelModel:
    """Scaler, map and the linear model on the mapped rows. Rows with a missing measure get no margins."""

    owner: KernelSVM
    scaler: ScalerModel | None
    f: object
    inner: MarginModel | None = None

    @property
    def problems(self):  # noqa: ANN201
        return self.inner.problems

    @property
    def classes(self) -> int:
        return self.inner.classes

    def mapped(self, df: DataFrame) -> DataFrame:
        return mapped(df, self.owner.array(self.scaler), self.f)

    def margins(self, df: DataFrame, out: str) -> DataFrame:
        W, b = self.inner.coefficients[:, :-1], self.inner.coefficients[:, -1]
        f = self.f
        return mapped(df, self.owner.array(self.scaler), lambda x: f(x) @ W.T + b, out)  # one Python step, only the margins leave it

    def guess(self, raw: Column) -> Column:
        return self.inner.guess(raw)

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.margins(df, "__raw")
        return out.select(*[F.col(name(c)) for c in df.columns], self.guess(F.col("__raw")).alias("prediction"), F.lit(None).cast("array<double>").alias("probability"))


@dataclass(frozen=True)
class KernelSVM:
    """Squared hinge on a kernel map, classes in pairs; labels are 0..K-1.

    ``probability`` adds cross-fitted sigmoids and pairwise coupling. ``candidates`` bounds the rows among which landmarks are chosen.
    """

    features: tuple[str, ...]
    label: str
    C: float = 1.0
    gamma: float | str = "scale"
    kernel: str = "rbf"
    degree: int = 3
    coef0: float = 0.0
    n_components: int = 200
    scale: str | None = "robust"
    probability: bool = True
    approximation: str = "landmarks"
    max_monomials: int = 1000
    candidates: int = 2000
    weighting: str | None = "balanced"
    max_iter: int = 200
    tol: float = 1e-6
    seed: int = 42

    def array(self, scaler: ScalerModel | None) -> Column:
        return F.array(*[scaler.value(c) if scaler else F.col(name(c)).cast("double") for c in self.features])

    def map_for(self, df: DataFrame, scaler: ScalerModel | None) -> object:
        d = len(self.features)
        gamma = gamma_scale(df, self.features, scaler) if self.gamma == "scale" else float(self.gamma)
        kernel = Kernel(self.kernel, gamma, self.degree, self.coef0)
        if self.kernel == "poly":
            small = monomial_count(d, self.degree, self.coef0) <= self.max_monomials
            return Monomials(d, kernel) if small else TensorSketch(d, kernel, self.n_components, self.seed)
        if self.kernel == "rbf" and self.approximation == "fourier":
            return Fourier(d, gamma, self.n_components, self.seed)
        return Landmarks(candidates_of(df, self.array(scaler), d, self.candidates, self.seed), kernel, self.n_components, self.seed)

    def fit(self, df: DataFrame):  # noqa: ANN201
        if self.probability:
            return Calibrated(replace(self, probability=False), self.features, self.label).fit(df)
        return self.fit_all(df, [self.C])[0]

    def fit_all(self, df: DataFrame, penalties: Sequence[float]) -> list[KernelModel]:
        """A model without probabilities for each ``C``: one map, all solved in the same passes."""
        return self._with_map(df, None, lambda inner, rows: inner.fit_all(rows, penalties))

    def fit_folds(self, df: DataFrame, fold: str, folds: int, then: Callable) -> tuple[KernelModel, object]:
        """As for the linear recipe; scaler and map are those of all rows."""
        model, found = self._with_map(df, fold, lambda inner, rows: inner.fit_folds(rows, fold, folds, then))
        return model, found

    def _with_map(self, df: DataFrame, fold: str | None, solve: Callable) -> list:
        df = df.where(F.col(name(self.label)).isNotNull())
        scaler = fit_scaler(df, self.features, self.scale)
        start = KernelModel(self, scaler, self.map_for(df, scaler))
        rows = cached(start.mapped(df).where(F.col(MAP).isNotNull()).select(MAP, name(self.label), *([name(fold)] if fold else [])))
        try:
            out = solve(SquaredHinge(MAP, self.label, self.C, self.max_iter, None, self.weighting, self.tol, pairs=True), rows)
        finally:
            rows.unpersist()
        return [replace(start, inner=m) if isinstance(m, MarginModel) else m for m in out]


def rbf_svm(features: Sequence[str], label: str, C: float = 1.0, gamma: float | str = "scale", n_components: int = 200, **options) -> KernelSVM:
    return KernelSVM(tuple(features), label, C, gamma, n_components=n_components, **options)
