"""Forests and boosted trees with the parameters of the library's recipes; the trees are those of ``binned``."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame

from sparktab.models.binned import Bagging, BinnedLearner, Boosting, Gini, Newton
from sparktab.operators.metrics import scores_of


def random_forest(
    features: Sequence[str] | str, label: str, trees: int = 100, depth: int | None = 20, min_leaf: int = 2, strategy: str = "sqrt",
    seed: int = 42, weighting: str | None = "balanced", min_split: int = 5, key: str | None = None, **options,
) -> BinnedLearner:
    """``strategy``: ``sqrt`` (rounded down, at least one) or ``all`` features at each node. ``depth`` None: no limit."""
    def make(classes: int, width: int) -> Bagging:
        some = max(1, math.isqrt(width)) if strategy == "sqrt" else max(1, width)
        return Bagging(classes, trees, depth, Gini(classes, min_split, min_leaf), some, seed)

    return BinnedLearner(features if isinstance(features, str) else tuple(features), label, make, weighting, key, **options)


def large_forest(features: Sequence[str] | str, label: str, trees: int = 500, seed: int = 42, key: str | None = None, **options) -> BinnedLearner:
    """Many trees without a depth limit, leaves of one row."""
    return random_forest(features, label, trees, None, 1, "sqrt", seed, min_split=2, key=key, **options)


def out_of_bag(learner: BinnedLearner, df: DataFrame) -> dict[str, float]:
    """Scores of a forest on each row by the trees whose bags left it out."""
    return scores_of([r.asDict() for r in learner.out_of_bag(df)[1].collect()])  # one row for each pair of classes


def gbt(
    features: Sequence[str] | str, label: str, rounds: int = 100, depth: int = 6, rate: float = 0.1, rows: float = 0.8, cols: float = 0.8, gamma: float = 0.0,
    seed: int = 42, weighting: str | None = "ratio", l1: float = 0.0, l2: float = 1.0, min_child: float = 1.0, key: str | None = None, **options,
) -> BinnedLearner:
    """Second-order boosting; the positive class weighs n0/n1. More than two classes: one tree for each class and round on the softmax loss.

    l1, l2: penalties of leaf values; gamma: least gain of a split; min_child: least hessian of a child; rows, cols: shares drawn for each round and tree.
    """
    def make(classes: int, width: int) -> Boosting:
        return Boosting(classes, rounds, depth, rate, rows, cols, Newton(l1, l2, min_child), gamma, seed)

    return BinnedLearner(features if isinstance(features, str) else tuple(features), label, make, weighting, key, **options)


def large_gbt(
    features: Sequence[str] | str, label: str, rounds: int = 500, depth: int = 5, rate: float = 0.05, cols: float = 1.0, gamma: float = 0.0, l1: float = 0.1, l2: float = 2.0, **options,
) -> BinnedLearner:
    """The slow, regularised variant."""
    return gbt(features, label, rounds, depth, rate, 0.8, cols, gamma, l1=l1, l2=l2, **options)
