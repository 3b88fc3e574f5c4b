"""What a classifier is here: something fitted on a DataFrame that adds
``prediction`` and, where it can, ``probability`` columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.functions.expressions import name
from sparktab.operators.features import fit_scaler
from sparktab.operators.split import per_class
from sparktab.session import ensure_checkpoint_dir

VECTOR = "__features"
WEIGHT = "__weight"


@dataclass(frozen=True)
class FitContext:
    """What an estimator may need to know about its training rows."""

    rows: int
    total_weight: float
    classes: int


@dataclass
class Fitted:
    """Scaler, vector assembly and a trained MLlib model as one transform."""

    features: Sequence[str] | str
    scaler: object
    model: Model
    classes: int

    def transform(self, df: DataFrame) -> DataFrame:
        keep = df.columns
        out = self.model.transform(_assembled(df, self.features, self.scaler))
        if "probability" in out.columns:
            prob = vector_to_array("probability")
        elif "rawPrediction" in out.columns and self.classes > 2:
            raw = vector_to_array("rawPrediction")
            e = F.transform(raw, lambda v: F.exp(v - F.array_max(raw)))
            prob = F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, x: a + x))
        else:
            prob = F.lit(None).cast("array<double>")
        return out.select(*keep, F.col("prediction").cast("int").alias("prediction"), prob.alias("probability"))


def _assembled(df: DataFrame, features: Sequence[str] | str, scaler) -> DataFrame:
    if isinstance(features, str):  # already one array column
        return df.withColumn(VECTOR, array_to_vector(features))
    cols = [scaler.sql(c) if scaler else f"double({name(c)})" for c in features]
    return df.withColumn(VECTOR, array_to_vector(F.expr(f"array({', '.join(cols)})")))


@dataclass(frozen=True)
class Learner:
    """Recipe of a classifier. ``make`` gets the weights' total, as the
    regularisation of some estimators depends on it.

    ``features`` are numeric columns or the name of one array column.
    ``weighting`` is ``balanced``, ``ratio`` (positive class only) or None.
    Labels are 0..K-1.
    """

    features: tuple[str, ...] | str
    label: str
    make: Callable[[FitContext], Estimator]
    weighting: str | None = "balanced"
    scale: str | None = None

    def fit(self, df: DataFrame) -> Fitted:
        ensure_checkpoint_dir(df.sparkSession)  # tree ensembles cut their lineage there
        df = df.where(F.col(self.label).isNotNull())
        counts = {r[0]: r[1] for r in df.groupBy(self.label).count().collect()}
        rows = sum(counts.values())
        weights = {c: 1.0 for c in counts}
        if self.weighting == "balanced":
            weights = {c: rows / (len(counts) * n) for c, n in counts.items()}
        elif self.weighting == "ratio":
            weights[1] = counts.get(0, 0) / counts[1] if counts.get(1) else 1.0
        total = sum(counts[c] * weights[c] for c in counts)
        context = FitContext(rows, total, max(2, int(max(counts)) + 1 if counts else 2))
        names = [self.features] if isinstance(self.features, str) else self.features
        scaler = None if isinstance(self.features, str) else fit_scaler(df, names, self.scale)
        label = F.col(self.label)
        data = _assembled(df.select(*names, self.label), self.features, scaler).select(
            VECTOR, label.cast("double").alias("__label"), per_class(label, weights).alias(WEIGHT)
        )
        return Fitted(self.features, scaler, self.make(context).fit(data), context.classes)


def columns_of(cls, **params):
    """Build an MLlib estimator on the shared column names."""
    return cls(featuresCol=VECTOR, labelCol="__label", **params)


def predict(model, df: DataFrame, key: str) -> DataFrame:
    """``key, prediction, probability`` of every row."""
    return model.transform(df).select(key, "prediction", "probability")


def refit(learner, df: DataFrame):
    """Train the chosen recipe again on all rows."""
    return learner.fit(df)

