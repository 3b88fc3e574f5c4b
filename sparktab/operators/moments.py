"""Moments of many columns at once.

One aggregation with hundreds of aggregate expressions compiles into code too
large to be optimised. Beyond a few columns each task therefore sums its Arrow
batches with NumPy and hands on one short row per column; Spark combines those.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sparktab.functions.expressions import finite

FEW_COLUMNS = 8


@dataclass(frozen=True)
class Moments:
    rows: int
    n: int
    mean: float | None
    m2: float
    low: float | None
    high: float | None

    def std(self, ddof: int) -> float | None:
        return (self.m2 / (self.n - ddof)) ** 0.5 if self.n > ddof else None


def _matrix(batch: pa.RecordBatch, first: int = 0) -> np.ndarray:
    """Columns from ``first`` on as doubles; NULL and infinities become NaN."""
    cols = [c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns[first:]]
    x = np.column_stack(cols) if cols else np.empty((batch.num_rows, 0))
    return np.where(np.isfinite(x), x, np.nan)


def _merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Combine (rows, n, mean, m2, low, high) per column (Chan et al.)."""
    n = a[1] + b[1]
    gap = b[2] - a[2]
    share = np.divide(b[1], n, out=np.zeros_like(n), where=n > 0)
    mean = np.where(a[1] == 0, b[2], a[2] + gap * share)
    return np.stack([a[0] + b[0], n, mean, a[3] + b[3] + gap**2 * a[1] * share, np.minimum(a[4], b[4]), np.maximum(a[5], b[5])])


def _summary(x: np.ndarray) -> np.ndarray:
    ok = ~np.isnan(x)
    n = ok.sum(0).astype("float64")
    z = np.where(ok, x, 0.0)
    mean = np.divide(z.sum(0), n, out=np.zeros_like(n), where=n > 0)
    m2 = (np.where(ok, x - mean, 0.0) ** 2).sum(0)
    low = np.where(ok, x, np.inf).min(0)
    high = np.where(ok, x, -np.inf).max(0)
    return np.stack([np.full_like(n, len(x)), n, mean, m2, low, high])


NAMES = ("rows", "n", "mean", "m2", "low", "high")
SCHEMA = "pos int, rows double, n double, mean double, m2 double, low double, high double"


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            part = _summary(_matrix(batch))
            total = part if total is None else _merge(total, part)
    if total is not None:
        pos = pa.array(np.arange(total.shape[1], dtype="int32"))
        yield pa.RecordBatch.from_arrays([pos, *[pa.array(v) for v in total]], names=["pos", *NAMES])


def _combine(parts: pd.DataFrame) -> pd.DataFrame:
    rows = parts[list(NAMES)].to_numpy().T
    total = rows[:, :1]
    for i in range(1, rows.shape[1]):
        total = _merge(total, rows[:, i : i + 1])
    return pd.DataFrame({"pos": parts["pos"].iloc[:1].to_numpy(), **{n: v for n, v in zip(NAMES, total)}})


def column_moments(df: DataFrame, cols: Sequence[str]) -> dict[str, Moments]:
    """Count, mean, squared deviations, min and max of the finite values of each column."""
    if not cols:
        return {}
    if len(cols) <= FEW_COLUMNS:
        aggs = [F.count("*").alias("rows")]
        for i, c in enumerate(cols):
            x = finite(F.col(f"`{c}`"))
            aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}"), F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}")]
        r = df.agg(*aggs).first()
        return {
            c: Moments(r["rows"], r[f"n{i}"], r[f"m{i}"], (r[f"v{i}"] or 0.0) * r[f"n{i}"], r[f"l{i}"], r[f"h{i}"])
            for i, c in enumerate(cols)
        }
    narrow = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    found = narrow.mapInArrow(_partials, SCHEMA).groupBy("pos").applyInPandas(_combine, SCHEMA).collect()
    out = {c: Moments(0, 0, None, 0.0, None, None) for c in cols}
    for r in found:  # one row per column
        n = int(r["n"])
        out[cols[r["pos"]]] = Moments(int(r["rows"]), n, *((r["mean"], r["m2"], r["low"], r["high"]) if n else (None, 0.0, None, None)))
    return out


def class_moments(df: DataFrame, cols: Sequence[str], by: str) -> dict:
    """The same per class, in one pass: ``{class: {column: Moments}}``. NULL classes are left out."""
    kind = df.schema[by].dataType

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = {}
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            codes, x = coded.indices.to_numpy(zero_copy_only=False), _matrix(batch, 1)
            for i, v in enumerate(coded.dictionary.to_pylist()):
                part = _summary(x[codes == i])
                totals[v] = _merge(totals[v], part) if v in totals else part
        for v, total in totals.items():
            width = total.shape[1]
            head = [pa.array([v] * width, type=to_arrow_type(kind)), pa.array(np.arange(width, dtype="int32"))]
            yield pa.RecordBatch.from_arrays([*head, *[pa.array(m) for m in total]], names=["g", "pos", *NAMES])

    def combine(parts: pd.DataFrame) -> pd.DataFrame:
        out = _combine(parts)
        out.insert(0, "g", parts["g"].iloc[:1].to_numpy())
        return out

    schema = f"g {kind.simpleString()}, {SCHEMA}"
    narrow = df.where(F.col(by).isNotNull()).select(F.col(by).alias("g"), *[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    found: dict = {}
    for r in narrow.mapInArrow(partials, schema).groupBy("g", "pos").applyInPandas(combine, schema).collect():
        found.setdefault(r["g"], {})[cols[r["pos"]]] = Moments(int(r["rows"]), int(r["n"]), r["mean"], r["m2"], r["low"], r["high"])
    return found


def pairwise_corr(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """Pearson correlations over the rows where both values are finite.

    Values are centred on the column means first, so the sums stay accurate.
    """
    centre = np.array([m.mean or 0.0 for m in column_moments(df, cols).values()])
    d = len(cols)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        total = np.zeros((4, d, d))
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch) - centre
                ok = (~np.isnan(x)).astype("float64")
                z = np.where(ok > 0, x, 0.0)
                total += np.stack([ok.T @ ok, z.T @ ok, (z**2).T @ ok, z.T @ z])
        flat = pa.array([total.ravel().tolist()], type=pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([flat], names=["v"])

    narrow = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    parts = narrow.mapInArrow(sums, "v array<double>").select(F.posexplode("v"))
    flat = parts.groupBy("pos").agg(F.sum("col").alias("s")).toPandas().sort_values("pos")["s"].to_numpy()
    n, sx, sxx, sxy = flat.reshape(4, d, d)
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = sxy - sx * sx.T / n
        var = sxx - sx**2 / n
        return cov / np.sqrt(var * var.T)
