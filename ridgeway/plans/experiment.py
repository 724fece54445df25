"""One experiment: labels, folds, penalty choice, final fit, test score, comparison.

The rows are read for two aggregations only: label frequencies of the coded
columns, and second moments per fold (the test rows being one more group). All
fits and scores follow from the moments. Designs too wide for that are fitted
by conjugate gradients, all penalties and folds in the same passes. The comparison with Spark's own LinearRegression is a third
step that can be left out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.operators import wide
from ridgeway.operators.columns import FeatureSpec, random_subset
from ridgeway.operators.crossval import ALPHAS, best_alpha, mean_scores, score_folds
from ridgeway.operators.encode import (
    MAX_LABELS,
    TooManyLabels,
    design_vectors,
    fit_labels,
    index_by_ranks,
    label_counts,
    predict_design,
    rank_labels,
)
from ridgeway.operators.mllib import linear_regression, r2_on, solver_for
from ridgeway.operators.moments import MAX_WIDTH, Design, Moments, moments
from ridgeway.operators.ridge import LinearFit, fit_moments, r2_from_moments
from ridgeway.operators.rows import drop_null_label, fill_nulls
from ridgeway.operators.solvers import principal_axes
from ridgeway.operators.split import fold_index, split_index
from ridgeway.sources.stage import reused, staged_for

TEST_PART = -1
RESULT_SCHEMA = "step string, alpha double, r2 double"

FoldScore = tuple[float, int, float | None]
# scores on the folds, the penalty chosen, the model, its score on the test rows
Outcome = tuple[list[FoldScore], float, "LinearFit", float | None]


@dataclass(frozen=True)
class Preset:
    """Which features an experiment uses and how it chooses the penalty.

    ``categoricals`` is the number of categorical columns drawn at random
    (None: all). A single penalty is used as it is, without cross-validation.
    """

    name: str
    categoricals: int | None
    pca_k: int | None = None
    alphas: tuple[float, ...] = ALPHAS

    def select(self, spec: FeatureSpec, seed: int = 0) -> FeatureSpec:
        if self.categoricals is None:
            return spec
        return spec.with_categoricals(random_subset(spec.categoricals, self.categoricals, seed))


# fixed values: the five experiments, on a table of 150 categorical columns
PRESETS = {
    p.name: p
    for p in (
        Preset("experiment1", categoricals=0),
        Preset("experiment2", categoricals=25),
        Preset("experiment3", categoricals=100),
        Preset("experiment4", categoricals=None, pca_k=75),
        Preset("experiment5", categoricals=None, alphas=(1.0,)),
    )
}


@dataclass(frozen=True)
class ExperimentResult:
    name: str
    design: Design
    fold_scores: list[FoldScore]
    alpha: float
    fit: LinearFit
    ridge_r2: float | None
    mllib_r2: float | None
    compared: bool
    # how the model compared with was solved, and the components used (None: no reduction)
    mllib_solver: str | None = None
    components: int | None = None
    # tables (value, rank) of the ordinals whose labels are too many for the driver
    ranks: Mapping[str, DataFrame] = field(default_factory=dict)

    def rows(self) -> list[tuple[str, float, float | None]]:
        """Mean score per penalty, then the test scores at the chosen penalty."""
        rows = [("cv", a, s) for a, s in sorted(mean_scores(self.fold_scores).items())]
        rows.append(("ridge", self.alpha, self.ridge_r2))
        if self.compared:
            rows.append(("mllib", self.alpha, self.mllib_r2))
        return rows

    def frame(self, spark) -> DataFrame:
        return spark.createDataFrame(self.rows(), RESULT_SCHEMA)

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Score any table that holds the raw feature columns."""
        if not self.ranks:
            return predict_design(df, self.design, self.fit, name)
        # ranks stand in for the columns while they are scored
        read = {c: f"_read_{c}" for c in self.ranks}
        ranked = index_by_ranks(df.select("*", *(F.col(c).alias(r) for c, r in read.items())), self.ranks)
        scored = predict_design(ranked, self.design, self.fit, name)
        kept = [F.col(read.get(c, c)).alias(c) for c in df.columns if c != name]
        return scored.select(*kept, name)


def prepare(
    df: DataFrame,
    spec: FeatureSpec,
    folds: int = 5,
    weights: Sequence[float] = (0.7, 0.3),
    seed: int = 0,
) -> DataFrame:
    """Labelled rows with nulls filled and a ``part``: the fold, or -1 for test rows.

    Keys are needed for the digest only and do not go further.
    """
    spec.validate(df.columns)
    if not spec.keys:
        raise ValueError("a reproducible split needs key columns")
    rows = fill_nulls(drop_null_label(df, spec.label), spec.numericals)
    is_train = split_index(spec.keys, weights, seed) == 0
    part = F.when(is_train, fold_index(spec.keys, folds, seed)).otherwise(F.lit(TEST_PART))
    return rows.select(part.alias("part"), spec.label, *spec.features)


def make_design(train: DataFrame, spec: FeatureSpec, max_labels: int = MAX_LABELS) -> Design:
    """Labels from the training rows; a categorical without any label is left out."""
    labels = fit_labels(train, [*spec.ordinals, *spec.categoricals], max_labels=max_labels)
    categoricals = tuple(c for c in spec.categoricals if labels[c])
    return Design(spec.numericals, spec.ordinals, categoricals, labels=labels)


def rank_tables(
    train: DataFrame, spec: FeatureSpec, max_labels: int = MAX_LABELS
) -> dict[str, DataFrame]:
    """Tables (value, rank) of the ordinals with most labels, so that the driver can hold the others'.

    One-hot columns have a weight per label, so theirs must fit: more are an error.
    """
    counts = label_counts(train, [*spec.ordinals, *spec.categoricals]).groupBy("column_name").count()
    sizes = {row["column_name"]: row["count"] for row in counts.collect()}  # a row per column
    left, moved = sum(sizes.values()), []
    for column in sorted(spec.ordinals, key=lambda c: -sizes.get(c, 0)):
        if left <= max_labels:
            break
        left -= sizes.get(column, 0)
        moved.append(column)
    if left > max_labels:
        raise TooManyLabels(f"the categoricals hold {left} labels, more than {max_labels}")
    return {c: rank_labels(train, c) for c in moved}


def scale_basis(train: Moments, pca_k: int | None = None) -> np.ndarray:
    """1/std per feature (0 where it does not vary), or that times principal axes."""
    std = train.std
    inverse = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
    if pca_k is None:
        return inverse
    correlation = train.covariance * np.outer(inverse, inverse)
    axes, _ = principal_axes(correlation, min(pca_k, train.p))
    return inverse[:, None] * axes


def run_experiment(
    df: DataFrame,
    spec: FeatureSpec,
    preset: Preset,
    *,
    folds: int = 5,
    weights: Sequence[float] = (0.7, 0.3),
    seed: int = 0,
    compare: bool = True,
    refit_per_fold: bool = False,
    keep: str = "table",
    max_labels: int = MAX_LABELS,
) -> ExperimentResult:
    """Run a preset on a table.

    Features are scaled by the whole training set before folds are cut;
    ``refit_per_fold`` scales by each fold's own training rows instead.

    The driver holds ``max_labels`` labels at most. Ordinals beyond that are replaced by
    ranks from a table that is joined; the result is the same. ``pca_k`` above the number of
    features means all of them.

    ``keep`` says what happens to the prepared rows between the passes: 'table'
    writes them to the shared folder (which survives executors) and deletes them
    at the end, 'cache' holds them in the executors' memory and disk, 'nothing'
    prepares them anew for each pass (the cheapest where there is no join and no
    comparison).
    """
    spec = preset.select(spec, seed)
    rows = prepare(df, spec, folds, weights, seed)
    if keep == "cache":
        with reused(rows) as kept:
            return _run(kept, spec, preset, compare, refit_per_fold, max_labels)
    if keep == "table":
        with staged_for(rows, preset.name) as kept:
            return _run(kept, spec, preset, compare, refit_per_fold, max_labels)
    if keep != "nothing":
        raise ValueError("keep must be 'cache', 'table' or 'nothing'")
    return _run(rows, spec, preset, compare, refit_per_fold, max_labels)


def _run(
    rows: DataFrame,
    spec: FeatureSpec,
    preset: Preset,
    compare: bool,
    refit_per_fold: bool,
    max_labels: int,
) -> ExperimentResult:
    train_rows = rows.filter(F.col("part") != TEST_PART)
    try:
        design = make_design(train_rows, spec, max_labels)
    except TooManyLabels:
        ranks = rank_tables(train_rows, spec, max_labels)
        joined = spec.with_ranks(list(ranks))
        with staged_for(index_by_ranks(rows, ranks), f"{preset.name}-ranked") as kept:
            result = _run(kept, joined, preset, compare, refit_per_fold, max_labels)
        return replace(result, ranks=ranks)
    used = spec.with_categoricals(design.categoricals)
    width = len(design.terms)
    pca_k = preset.pca_k and min(preset.pca_k, width)

    solver, mllib_r2, features = solver_for(pca_k or width), None, None
    if width > MAX_WIDTH:
        basis, outcome = _fit_wide(rows, design, spec.label, preset.alphas, pca_k, refit_per_fold)
    else:
        table = moments(rows, design, spec.label, by=["part"])
        per_part = {group[0]: m for group, m in table.collect().items()}
        basis, outcome = _fit_moments(per_part, preset.alphas, pca_k, refit_per_fold)
    scores, alpha, fit, ridge_r2 = outcome
    if compare:
        features = design_vectors(rows, design, basis, ["part", spec.label])

    if features is not None:
        train = features.filter(F.col("part") != TEST_PART)
        model = linear_regression(train, spec.label, alpha, solver=solver)
        mllib_r2 = r2_on(model, features.filter(F.col("part") == TEST_PART), spec.label)
    return ExperimentResult(
        preset.name, design, scores, alpha, fit, ridge_r2, mllib_r2, compare, solver if compare else None, pca_k
    )


def _fit_moments(
    per_part: dict[int, Moments],
    alphas: Sequence[float],
    pca_k: int | None,
    refit_per_fold: bool,
    scaled: bool = False,
) -> tuple[np.ndarray, Outcome]:
    """The feature scale, and penalty, model and test score from the moments of the parts."""
    per_fold = {part: m for part, m in per_part.items() if part != TEST_PART}
    if not per_fold:
        raise ValueError("no training rows")
    train = reduce(add, per_fold.values())
    basis = np.ones(train.p) if scaled else scale_basis(train, pca_k)
    scores: list[FoldScore] = []
    alpha = alphas[0]
    if len(alphas) > 1:
        rule = (lambda m: scale_basis(m, pca_k)) if refit_per_fold else basis
        scores = score_folds(per_fold, alphas, rule)
        alpha = best_alpha(mean_scores(scores))
    fit = fit_moments(train, alpha, basis)
    test = per_part.get(TEST_PART)
    return basis, (scores, alpha, fit, r2_from_moments(test, fit) if test else None)


def _fit_wide(
    rows: DataFrame,
    design: Design,
    label: str,
    alphas: Sequence[float],
    pca_k: int | None,
    refit_per_fold: bool,
) -> tuple[np.ndarray, Outcome]:
    """The same without a Gram matrix: all penalties and folds in the same passes."""
    blocks = wide.WideRows(rows, design, label)
    folds = [int(p) for p in blocks.parts if p != TEST_PART]
    if not folds:
        raise ValueError("no training rows")
    if refit_per_fold:
        raise ValueError("designs without a Gram matrix are scaled by all training rows")
    sums = blocks.sums()
    scale = wide.scales(sums, np.isin(blocks.parts, folds))
    if pca_k:
        basis = scale[:, None] * wide.principal_axes(blocks, sums, scale, folds, pca_k)
        scored = wide.projected(blocks, basis, label)
        table = moments(scored, Design(arrays=(("scores", pca_k),)), label, by=["part"])
        per_part = {group[0]: m for group, m in table.collect().items()}
        scores, alpha, fit, test_r2 = _fit_moments(per_part, alphas, None, False, scaled=True)[1]
        slopes = basis @ fit.slopes
        intercept = fit.intercept - blocks.pivot[:-1] @ slopes
        return basis, (scores, alpha, LinearFit(design.terms, float(intercept), slopes), test_r2)

    held = [*folds, None] if len(alphas) > 1 else [None]
    systems = [wide.System(a, f) for a in alphas for f in held]
    slopes, intercepts = wide.solve(blocks, sums, scale, systems, folds)
    # a fold's complement is scored on the fold, all training rows on the test rows
    scored_on = [TEST_PART if s.held_out is None else s.held_out for s in systems]
    uses = np.stack([blocks.parts == part for part in scored_on], axis=1)
    errors = blocks.squared_errors(slopes, intercepts, uses)
    found: dict[wide.System, float | None] = {}
    for system, use, error in zip(systems, uses.T, errors):
        part = sums.over(use)
        total = part.yy - part.y**2 / part.n if part.n else 0.0
        found[system] = float(1 - error / total) if total > 1e-13 * part.yy else None
    scores = [(float(s.alpha), s.held_out, found[s]) for s in systems if s.held_out is not None]
    alpha = best_alpha(mean_scores(scores)) if scores else alphas[0]
    chosen = systems.index(wide.System(alpha, None))
    slope = slopes[:, chosen]
    intercept = intercepts[chosen] + blocks.pivot[-1] - blocks.pivot[:-1] @ slope
    return scale, (scores, alpha, LinearFit(design.terms, float(intercept), slope), found[systems[chosen]])
