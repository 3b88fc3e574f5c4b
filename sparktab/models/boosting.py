"""Adaptive boosting of shallow trees (SAMME, Zhu et al. 2009) on binned features."""

from __future__ import annotations

from collections.abc import Sequence

from sparktab.models.binned import Adaptive, BinnedLearner, Gini


def adaboost(
    features: Sequence[str] | str, label: str, rounds: int = 100, rate: float = 0.1, depth: int = 3, min_leaf: int = 2, min_split: int = 5, seed: int = 42, key: str | None = None, **options,
) -> BinnedLearner:
    """One tree per round on reweighted rows; the balanced class weight enters every tree on top of the boosting weight."""
    def make(classes: int, width: int) -> Adaptive:
        return Adaptive(classes, rounds, depth, rate, Gini(classes, min_split, min_leaf), seed)

    return BinnedLearner(features if isinstance(features, str) else tuple(features), label, make, "balanced", key, **options)
