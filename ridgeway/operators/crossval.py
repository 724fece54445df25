"""K-fold cross-validation over a penalty grid, without refitting on rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.operators.metrics import best_by_score
from ridgeway.operators.moments import Design, Moments, moments
from ridgeway.operators.ridge import fit_path, r2_from_moments

ALPHAS = (0.01, 0.1, 1.0)
SCORE_SCHEMA = "alpha double, fold int, r2 double"

BasisRule = Callable[[Moments], np.ndarray | None]


def score_folds(
    per_fold: Mapping[int, Moments],
    alphas: Sequence[float] = ALPHAS,
    basis: np.ndarray | BasisRule | None = None,
) -> list[tuple[float, int, float | None]]:
    """(alpha, fold, R² on the fold of the model fitted on the other folds).

    The training moments are those of the other folds, merged. ``basis`` fixes the
    feature scale for all folds; a rule is applied to each training set anew. Each
    training set is decomposed once, whatever the number of penalties.
    """
    scores = []
    for fold, held_out in sorted(per_fold.items()):
        others = [m for k, m in per_fold.items() if k != fold]
        if not others:  # nothing to train on
            scores += [(float(alpha), int(fold), None) for alpha in alphas]
            continue
        train = reduce(add, others)
        fold_basis = basis(train) if callable(basis) else basis
        for alpha, fit in zip(alphas, fit_path(train, alphas, fold_basis)):
            scores.append((float(alpha), int(fold), r2_from_moments(held_out, fit)))
    order = {float(alpha): at for at, alpha in enumerate(alphas)}
    return sorted(scores, key=lambda s: (order[s[0]], s[1]))


def mean_scores(scores: Sequence[tuple[float, int, float | None]]) -> dict[float, float]:
    """Mean R² per penalty; folds without a score do not count."""
    grouped: dict[float, list[float]] = {}
    for alpha, _, score in scores:
        grouped.setdefault(alpha, [])
        if score is not None and not np.isnan(score):
            grouped[alpha].append(score)
    return {a: float(np.mean(s)) if s else float("-inf") for a, s in grouped.items()}


def best_alpha(means: Mapping[float, float]) -> float:
    """The penalty of the best mean score; a tie goes to the smallest penalty."""
    return min(means, key=lambda a: (float("inf") if np.isnan(means[a]) else -means[a], a))


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    alphas: Sequence[float] = ALPHAS,
    fold: str = "fold",
) -> DataFrame:
    """(alpha, fold, r2) from one aggregation over the rows."""
    table = moments(df, Design(numericals=tuple(features)), label, by=[fold])
    per_fold = {group[0]: m for group, m in table.collect().items()}
    return scores_frame(df.sparkSession, score_folds(per_fold, alphas))


def scores_frame(spark: SparkSession, scores) -> DataFrame:
    return spark.createDataFrame(list(scores), SCORE_SCHEMA)


def mean_by_alpha(scores: DataFrame) -> DataFrame:
    known = F.when(~F.isnan("r2"), F.col("r2"))
    return scores.groupBy("alpha").agg(F.avg(known).alias("mean_r2"))


def select_alpha(scores: DataFrame) -> DataFrame:
    return best_by_score(mean_by_alpha(scores), "alpha", "mean_r2")
