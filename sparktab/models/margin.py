"""Linear classifiers with the squared hinge: Newton steps on the primal, all classes side by side.

``|w|^2 / 2 + C sum(weight * max(0, 1 - s * w x)^2)`` with the intercept as one more penalised coefficient. The objective is convex and piecewise quadratic, so a few
steps reach the optimum. One aggregation gives gradients and second derivatives of all problems at the full step, and the objective along it; what a task hands on are
``problems * (d + 1)^2`` sums in pieces of bounded size, which are added up by piece.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.functions.expressions import best_index, name
from sparktab.models.learner import VECTOR, _assembled
from sparktab.operators.features import fit_scaler
from sparktab.operators.split import per_class
from sparktab.session import cached

PIECE = 4096
STEPS = tuple(0.5**k for k in range(12))


def add_up(rows: DataFrame, size: int, sums: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """``sums`` (a flat array of ``size``) over all batches: tasks add up theirs and hand them on in pieces, which are added up by piece."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = np.zeros(size)
        for b in batches:
            if b.num_rows:
                flat += sums(b)
        pieces = [flat[at : at + PIECE].tobytes() for at in range(0, size, PIECE)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(pieces)), pa.int32()), pa.array(pieces, pa.binary())], ["piece", "sums"])

    def added(table: pa.Table) -> pa.Table:
        return pa.table({"piece": table.column("piece")[:1], "sums": [sum(np.frombuffer(b) for b in table.column("sums").to_pylist()).tobytes()]})

    found = rows.mapInArrow(summed, "piece int, sums binary").groupBy("piece").applyInArrow(added, "piece int, sums binary").collect()  # a fixed number of sums
    return np.concatenate([np.frombuffer(r["sums"]) for r in sorted(found, key=lambda r: r["piece"])]) if found else np.zeros(size)


def sums_of(x: np.ndarray, sign: np.ndarray, weight: np.ndarray, w: np.ndarray, step: np.ndarray) -> np.ndarray:
    """For one problem: losses at ``w + t * step`` for all ``STEPS``, then gradient and second derivatives of the loss at the full step."""
    at, along = x @ w, x @ step
    losses = [float(weight @ np.maximum(0.0, 1 - sign * (at + t * along)) ** 2) for t in STEPS]
    gap = 1 - sign * (at + along)
    on = gap > 0
    z, v = x[on], weight[on]
    first = -2 * (v * sign[on] * gap[on]) @ z
    z *= np.sqrt(2 * v)[:, None]
    return np.concatenate([losses, first, (z.T @ z).ravel()])  # a product with itself costs half of any other


Problem = tuple[int, int | None]  # a class against another one, or against the rest


def totals(rows: DataFrame, points: np.ndarray, steps: np.ndarray, tasks: Sequence[tuple[int, int | None, int | None]]) -> np.ndarray:
    """``sums_of`` over all ``rows(x, y, w, fold)``, one line for each task: a problem and the fold that it leaves out, if any."""
    count, d = points.shape
    size = len(STEPS) + d + d * d

    def sums(b: pa.RecordBatch) -> np.ndarray:
        x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, d - 1)
        x, y, weight, fold = np.hstack([x, np.ones((len(x), 1))]), b.column(1).to_numpy(), b.column(2).to_numpy(), b.column(3).to_numpy()
        out = np.zeros((count, size))
        for one, other, left_out in dict.fromkeys(tasks):  # penalties share their rows
            part = np.ones(len(x), dtype=bool) if other is None else (y == one) | (y == other)
            if left_out is not None:
                part &= fold != left_out
            own, sign, heavy = x[part], np.where(y[part] == one, 1.0, -1.0), weight[part]
            for k in [k for k, task in enumerate(tasks) if task == (one, other, left_out)]:
                out[k] = sums_of(own, sign, heavy, points[k], steps[k])
        return out.ravel()

    return add_up(rows, count * size, sums).reshape(count, size)


def held_margins(rows: DataFrame, left_out: np.ndarray) -> DataFrame:
    """``margins, y`` of every row by the coefficients (folds, problems, d) that did not see its fold."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, left_out.shape[2] - 1)
            w = left_out[b.column(3).to_numpy()]
            margins = np.einsum("nd,npd->np", x, w[:, :, :-1]) + w[:, :, -1]
            yield pa.RecordBatch.from_arrays([pa.array(list(margins), pa.list_(pa.float64())), b.column(1)], ["margins", "y"])

    return rows.mapInArrow(scored, "margins array<double>, y int")


def newton(passes: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], w: np.ndarray, C: np.ndarray, ridge: float, max_iter: int, tol: float) -> np.ndarray:
    """Minima of ``ridge * |w|^2 / 2 + C * loss``, a line for each problem; a pass gives the sums described at ``sums_of`` for the problems it is asked for: those
    that have reached their minimum, or cannot get nearer to it, are left out."""
    w, d = w.copy(), w.shape[1]
    now = passes(w, np.zeros_like(w), np.arange(len(w)))
    first, moving = None, np.ones(len(w), dtype=bool)
    for _ in range(max_iter):
        grads = ridge * w + C[:, None] * now[:, len(STEPS) : len(STEPS) + d]
        norms = np.abs(grads).max(axis=1)
        first = norms if first is None else first
        moving &= norms > tol * np.maximum(first, 1e-12)
        some = np.flatnonzero(moving)
        if not len(some):
            break
        at, c, own = w[some], C[some], now[some]
        curves = ridge * np.eye(d) + c[:, None, None] * own[:, len(STEPS) + d :].reshape(-1, d, d)
        step = -np.linalg.solve(curves, grads[some][:, :, None])[:, :, 0]
        value = 0.5 * ridge * (at * at).sum(axis=1) + c * own[:, 0]
        after = passes(at, step, some)
        along = np.stack([0.5 * ridge * ((at + t * step) ** 2).sum(axis=1) + c * after[:, k] for k, t in enumerate(STEPS)], axis=1)
        slope = (grads[some] * step).sum(axis=1)
        good = along <= value[:, None] + 1e-4 * np.array(STEPS) * slope[:, None] + 1e-12 * np.abs(value[:, None])
        size = np.where(good.any(axis=1), np.array(STEPS)[good.argmax(axis=1)], 0.0)
        w[some] = at + size[:, None] * step
        moving[some] = size > 0
        now[some] = after
        short = some[(size > 0) & (size < 1)]
        if len(short):
            now[short] = passes(w[short], np.zeros_like(w[short]), short)
    return w


@dataclass
class MarginModel:
    """Scaler and coefficients as one transform. One against the rest: no probabilities for two classes, softmax of the margins for more.
    Pairs: the class with most votes, no probabilities (see ``calibrate``)."""

    features: Sequence[str] | str
    scaler: object
    coefficients: np.ndarray
    classes: int
    problems: Sequence[Problem] = ()

    def margins(self, df: DataFrame, out: str) -> DataFrame:
        """``df`` with an array of one margin for each problem."""
        x = vector_to_array(VECTOR)
        raw = F.array(*[
            F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in w[:-1]]), lambda a, b: a * b), F.lit(float(w[-1])), lambda s, v: s + v) for w in self.coefficients
        ])
        return _assembled(df, self.features, self.scaler).withColumn(out, raw).drop(VECTOR)

    def guess(self, raw: Column) -> Column:
        """The class that margins speak for; the first one on ties."""
        if self.classes <= 2:
            return (raw[0] > 0).cast("int")
        if all(other is None for _, other in self.problems):
            return best_index(raw)
        ballots = F.array(*[F.when(raw[k] > 0, one).otherwise(other) for k, (one, other) in enumerate(self.problems)])
        return F.when(raw[0].isNotNull(), best_index(F.array(*[F.size(F.filter(ballots, F.lit(c).__eq__)) for c in range(self.classes)])))

    def transform(self, df: DataFrame) -> DataFrame:
        raw, prob = F.col("__raw"), F.lit(None).cast("array<double>")
        if self.classes > 2 and all(other is None for _, other in self.problems):
            e = F.transform(raw, lambda v: F.exp(v - F.array_max(raw)))
            prob = F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda s, u: s + u))
        out = self.margins(df, "__raw")
        return out.select(*[F.col(name(c)) for c in df.columns], self.guess(raw).alias("prediction"), prob.alias("probability"))


@dataclass(frozen=True)
class SquaredHinge:
    """Recipe of a linear classifier; labels are 0..K-1. More than two classes are one against the rest, or with ``pairs`` each against each."""

    features: tuple[str, ...] | str
    label: str
    C: float = 1.0
    max_iter: int = 2000
    scale: str | None = "standard"
    weighting: str | None = "balanced"
    tol: float = 1e-8
    pairs: bool = False

    def fit(self, df: DataFrame) -> MarginModel:
        return self.fit_all(df, [self.C])[0]

    def fit_all(self, df: DataFrame, penalties: Sequence[float]) -> list[MarginModel]:
        """A model for each ``C``. All are solved in the same passes over the rows."""
        return self.solved(df, penalties)[0]

    def fit_folds(self, df: DataFrame, fold: str, folds: int, then: Callable[[DataFrame, Sequence[Problem]], object]) -> tuple[MarginModel, object]:
        """The model of all rows, and ``then`` of the margins that models without a row's fold give it; all solved in the same passes. The scaler is that of all rows."""
        models, found = self.solved(df, [self.C], fold, folds, then)
        return models[0], found

    def solved(self, df: DataFrame, penalties: Sequence[float], fold: str | None = None, folds: int = 0, then: Callable | None = None) -> tuple[list[MarginModel], object]:
        df = df.where(F.col(name(self.label)).isNotNull())
        counts = {int(r[0]): r[1] for r in df.groupBy(name(self.label)).count().collect()}
        n = sum(counts.values())
        weights = {c: n / (len(counts) * m) if self.weighting == "balanced" else 1.0 for c, m in counts.items()}
        classes = max(2, max(counts, default=0) + 1)
        problems: list[Problem] = [(1, None)] if classes == 2 else list(combinations(range(classes), 2)) if self.pairs else [(c, None) for c in range(classes)]
        whole = isinstance(self.features, str)
        scaler = None if whole else fit_scaler(df, self.features, self.scale)
        label = F.col(name(self.label))
        kept = [vector_to_array(VECTOR).alias("x"), label.cast("int").alias("y"), per_class(label, weights).alias("w"), (F.col(name(fold)) if fold else F.lit(-1)).cast("int").alias("fold")]
        rows = cached(_assembled(df, self.features, scaler).select(*kept))
        first = rows.select(F.size("x").alias("n")).first()
        d = (first["n"] if first else 0 if whole else len(self.features)) + 1
        settings = [(c, k) for c in penalties for k in [None, *range(folds)]]
        tasks = [(*p, k) for _, k in settings for p in problems]
        C = np.repeat([float(c) for c, _ in settings], len(problems))
        try:
            w = newton(lambda at, step, some: totals(rows, at, step, [tasks[i] for i in some]), np.zeros((len(tasks), d)), C, 1.0, self.max_iter, self.tol)
            parts = w.reshape(len(penalties), 1 + folds, len(problems), d)
            found = then(held_margins(rows, parts[0, 1:]), problems) if then else None
        finally:
            rows.unpersist()
        return [MarginModel(self.features, scaler, part[0], classes, problems) for part in parts], found
