"""Logistic regression and linear SVM with the penalty given as ``C``.

MLlib minimises the weighted mean loss plus ``regParam`` times the penalty, the
source objective is ``C`` times the weighted sum plus the penalty; both have the
same optimum for ``regParam = 1 / (C * total weight)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression

from sparktab.models.learner import WEIGHT, FitContext, Learner, columns_of
from sparktab.models.margin import SquaredHinge


def logreg(
    features: Sequence[str] | str, label: str, C: float = 1.0, penalty: str = "l2", max_iter: int = 1000,
    scale: str | None = "standard", weighting: str | None = "balanced", tol: float = 1e-6,
) -> Learner:
    def make(c: FitContext):
        return columns_of(
            LogisticRegression, weightCol=WEIGHT, regParam=1.0 / (C * c.total_weight), maxIter=max_iter, tol=tol,
            elasticNetParam=1.0 if penalty == "l1" else 0.0, standardization=False,
        )

    return Learner(features if isinstance(features, str) else tuple(features), label, make, weighting, scale)


def linear_svm(
    features: Sequence[str] | str, label: str, C: float = 1.0, max_iter: int = 2000, scale: str | None = "standard", weighting: str | None = "balanced", tol: float = 1e-8,
) -> SquaredHinge:
    """Squared hinge; more than two classes are trained one against the rest, side by side."""
    return SquaredHinge(features if isinstance(features, str) else tuple(features), label, C, max_iter, scale, weighting, tol)
