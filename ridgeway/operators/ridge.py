"""Ridge regression from second moments.

Minimises ‖y − Xθ‖² + α‖slopes‖²; the intercept is not penalised, so the
problem is solved on centred moments and the intercept follows from the means.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasLabelCol,
    HasPredictionCol,
    Param,
    Params,
    TypeConverters,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ridgeway.functions.linear import dot, linear_column
from ridgeway.operators import solvers, wide
from ridgeway.operators.moments import (
    MAX_WIDTH,
    Design,
    Moments,
    MomentTable,
    moments,
)


@dataclass(frozen=True)
class LinearFit:
    """An intercept and one slope per term, on the raw scale of the features."""

    terms: tuple[str, ...]
    intercept: float
    slopes: np.ndarray

    def coefficients(self, spark) -> DataFrame:
        """(position, term, coefficient), the intercept first."""
        rows = [(0, "(intercept)", float(self.intercept))]
        rows += [(i + 1, t, float(b)) for i, (t, b) in enumerate(zip(self.terms, self.slopes))]
        return spark.createDataFrame(rows, "position int, term string, coefficient double")

    def column(self) -> Column:
        """The prediction as a native expression over plain numeric columns."""
        terms = zip(self.terms, self.slopes)
        return linear_column(self.intercept, [(F.col(t).cast("double"), b) for t, b in terms])

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, self.column())


def fit_moments(m: Moments, alpha: float, basis: np.ndarray | None = None) -> LinearFit:
    """Ridge on features ``basisᵀ·x`` (``x`` itself without a basis).

    A basis of 1/std on the diagonal is ridge on standardised features; its
    product with principal axes is ridge on principal components. The slopes
    returned are those of ``x``.
    """
    return fit_path(m, [alpha], basis)[0]


def fit_path(m: Moments, alphas: Sequence[float], basis: np.ndarray | None = None) -> list[LinearFit]:
    """:func:`fit_moments` for each penalty, from one decomposition of the matrix."""
    spread = m.centred[: m.p, : m.p]
    cross = m.centred[: m.p, -1]
    if basis is None:
        found = solvers.ridge_path(spread, cross, alphas)
    elif basis.ndim == 1:
        found = [basis * s for s in solvers.ridge_path(spread * np.outer(basis, basis), basis * cross, alphas)]
    else:
        found = [basis @ s for s in solvers.ridge_path(basis.T @ spread @ basis, basis.T @ cross, alphas)]
    return [LinearFit(m.terms, float(m.means[-1] - m.means[: m.p] @ slopes), slopes) for slopes in found]


def r2_from_moments(m: Moments, fit: LinearFit) -> float | None:
    """R² of a model on the rows behind ``m``; None where the label does not vary."""
    total = m.centred[-1, -1]
    if not total > 0.0:  # also where it is not a number
        return None
    weights = np.append(-fit.slopes, 1.0)
    bias = m.means[-1] - fit.intercept - m.means[: m.p] @ fit.slopes
    residual = weights @ m.centred @ weights + m.n * bias**2
    score = float(1.0 - residual / total)
    return None if np.isnan(score) else score


def fit_ridge(
    df: DataFrame, features: Sequence[str], label: str, alpha: float, plan: str = "auto"
) -> LinearFit:
    """Ridge over plain numeric columns; one aggregation, then one small solve."""
    table = moments(df, Design(numericals=tuple(features)), label, plan=plan)
    return fit_moments(only_moments(table), alpha)


def only_moments(table: MomentTable) -> Moments:
    found = table.collect()
    if not found or next(iter(found.values())).n == 0:
        raise ValueError("no rows to fit")
    return next(iter(found.values()))


def fit_ridge_grouped(
    df: DataFrame, features: Sequence[str], label: str, alpha: float, by: Sequence[str], plan: str = "auto"
) -> DataFrame:
    """One ridge model per group: (group…, term, coefficient).

    For any number of groups, at any distance from each other: the co-moments are
    merged per group, and the solves run where they are, a batch of groups at a time.
    """
    solvers.check_alpha(alpha)
    table = moments(df, Design(numericals=tuple(features)), label, by=by, plan=plan)
    # a matrix of p² numbers per group, in a few tiles
    stats = table.packed.groupBy(*by).agg(F.collect_list(F.struct("bi", "bj", "mi", "v")).alias("_tiles"))
    terms = ["(intercept)", *features]
    types = {f.name: f for f in df.schema.fields}
    schema = StructType(
        [types[b] for b in by]
        + [StructField("term", StringType()), StructField("coefficient", DoubleType())]
    )
    keys, size = list(by), len(features) + 1

    def solve(frames):
        for frame in frames:
            if not len(frame):
                continue
            found = [
                solvers.tiled(*([t[c] for t in tiles] for c in ("bi", "bj", "mi", "v")), size)
                for tiles in frame["_tiles"]
            ]
            theta = solvers.grouped_ridge(*(np.stack(x) for x in zip(*found)), alpha)
            repeated = frame[keys].loc[frame.index.repeat(len(terms))].reset_index(drop=True)
            yield repeated.assign(
                term=pd.Series(terms * len(frame), dtype=object), coefficient=theta.ravel()
            )

    return stats.mapInPandas(solve, schema)


def alpha_to_regparam(alpha: float, n: float, label_std: float) -> float:
    """The ``regParam`` with which Spark's LinearRegression solves the same problem.

    Its objective is 1/(2n)·RSS + regParam/2·‖slopes‖² on a label divided by its
    standard deviation (sample for 'l-bfgs', population for 'normal').
    """
    return alpha * label_std / n


def fit_ridge_wide(df: DataFrame, features: str, width: int, label: str, alpha: float) -> LinearFit:
    """The same problem for vectors too wide for a Gram matrix, by conjugate gradients.

    Nothing of size p² is formed. It ends with a small residual or fails.
    """
    solvers.check_alpha(alpha)
    design = Design(arrays=((features, width),))
    rows = wide.WideRows(df.select(features, label, F.lit(0).alias("part")), design, label)
    if not len(rows.parts):
        raise ValueError("no rows to fit")
    sums = rows.sums()
    scale = wide.scales(sums, np.ones(1, bool))
    slopes, intercepts = wide.solve(rows, sums, scale, [wide.System(alpha, None)], [0], raw_penalty=True)
    slope = slopes[:, 0]
    intercept = intercepts[0] + rows.pivot[-1] - rows.pivot[:-1] @ slope
    return LinearFit(design.terms, float(intercept), slope)


class _RidgeParams(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    alpha = Param(Params._dummy(), "alpha", "penalty on the slopes", TypeConverters.toFloat)

    def getAlpha(self) -> float:
        return self.getOrDefault(self.alpha)


class RidgeRegression(Estimator, _RidgeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Ridge regression on a vector column, for use in a Spark ML pipeline."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", alpha=1.0):
        super().__init__()
        self._setDefault(alpha=1.0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> RidgeRegressionModel:
        solvers.check_alpha(self.getAlpha())
        column = self.getFeaturesCol()
        width = vector_width(dataset, column)
        if width > MAX_WIDTH:
            fit = fit_ridge_wide(dataset, column, width, self.getLabelCol(), self.getAlpha())
            return self._copyValues(RidgeRegressionModel(fit.intercept, fit.slopes.tolist()))
        design = Design(arrays=((column, width),))
        fit = fit_moments(only_moments(moments(dataset, design, self.getLabelCol())), self.getAlpha())
        return self._copyValues(RidgeRegressionModel(fit.intercept, fit.slopes.tolist()))


class RidgeRegressionModel(Model, _RidgeParams, DefaultParamsReadable, DefaultParamsWritable):
    intercept = Param(Params._dummy(), "intercept", "intercept", TypeConverters.toFloat)
    slopes = Param(Params._dummy(), "slopes", "one slope per feature", TypeConverters.toListFloat)

    def __init__(self, intercept: float | None = None, slopes: list[float] | None = None):
        super().__init__()
        if slopes is not None:
            self._set(intercept=intercept, slopes=slopes)

    @property
    def coefficients(self) -> np.ndarray:
        """Intercept, then slopes."""
        return np.array([self.getOrDefault(self.intercept), *self.getOrDefault(self.slopes)])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        column = self.getFeaturesCol()
        values = F.col(column)
        if isinstance(dataset.schema[column].dataType, VectorUDT):
            values = vector_to_array(values)
        slopes = self.getOrDefault(self.slopes)
        score = F.lit(self.getOrDefault(self.intercept)) + dot(values, slopes)
        return dataset.withColumn(self.getPredictionCol(), score)


def vector_width(df: DataFrame, column: str) -> int:
    """Width of a vector column: from its metadata if there is any, else from one row."""
    width = df.schema[column].metadata.get("ml_attr", {}).get("num_attrs")
    if width is None:
        row = df.select(column).filter(F.col(column).isNotNull()).first()
        if row is None:
            raise ValueError(f"{column} holds no vector")
        width = len(row[0])
    return int(width)


def with_intercept(features: Column) -> Column:
    """1.0 in front of an array column; the column it is taken from stays as it is."""
    return F.concat(F.array(F.lit(1.0)), features)
