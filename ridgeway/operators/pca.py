"""Principal components from the covariance that the second moments give, or from a sketch of it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.functions.linear import linear_column, projection
from ridgeway.operators import wide
from ridgeway.operators.moments import MAX_WIDTH, Design, moments
from ridgeway.operators.ridge import only_moments
from ridgeway.operators.solvers import principal_axes


@dataclass(frozen=True)
class PrincipalComponents:
    """Axes as columns, with the variance along each and the total variance."""

    design: Design
    axes: np.ndarray
    variances: np.ndarray
    total_variance: float
    # how far each variance may be from one of the covariance matrix
    bounds: np.ndarray | None = None

    @property
    def k(self) -> int:
        return self.axes.shape[1]

    def transform(self, df: DataFrame, prefix: str = "pc") -> DataFrame:
        """Add pc1…pck: projections of the rows as they are, not centred.

        Plain columns are projected by native expressions; vectors by one matrix
        product per Arrow batch, which reads each vector once for all axes.
        """
        names = [f"{prefix}{i + 1}" for i in range(self.k)]
        if not self.design.arrays:
            plain = [F.col(c).cast("double") for c in self.design.numericals]
            return df.withColumns({n: linear_column(0.0, list(zip(plain, self.axes[:, i]))) for i, n in enumerate(names)})
        parts = [F.col(c).cast("array<double>") for c, _ in self.design.arrays]
        if self.design.numericals:
            parts.append(F.array(*(F.col(c).cast("double") for c in self.design.numericals)))
        scores = "_".join(["_scores", *names])
        found = df.withColumn(scores, projection(self.axes)(F.concat(*parts)))
        return found.withColumns({n: F.col(scores)[i] for i, n in enumerate(names)}).drop(scores)

    def explained_variance(self, spark: SparkSession) -> DataFrame:
        rows = [
            (i + 1, float(v), float(v / self.total_variance))
            for i, v in enumerate(self.variances)
        ]
        return spark.createDataFrame(rows, "component int, variance double, ratio double")


def fit_pca(
    df: DataFrame,
    k: int,
    numericals: Sequence[str] = (),
    arrays: Sequence[tuple[str, int]] = (),
    method: str = "auto",
) -> PrincipalComponents:
    """The k axes of largest variance; fewer if there are fewer features, as ``PrincipalComponents.k`` says.

    ``method`` is 'matrix' (exact, up to ``MAX_WIDTH`` features), 'sketch' (two passes at
    any width; ``bounds`` say how far each variance may be off) or 'auto'.
    """
    if method not in ("auto", "matrix", "sketch"):
        raise ValueError("method must be 'auto', 'matrix' or 'sketch'")
    design = Design(numericals=tuple(numericals), arrays=tuple(arrays))
    if method == "sketch" or method == "auto" and len(design.terms) > MAX_WIDTH:
        return _sketched(df, design, k)
    covariance = only_moments(moments(df, design)).covariance
    axes, variances = principal_axes(covariance, min(k, len(covariance)))
    return PrincipalComponents(design, axes, variances, float(np.trace(covariance)), np.zeros(len(variances)))


def _sketched(df: DataFrame, design: Design, k: int) -> PrincipalComponents:
    rows = df.select(*design.columns, F.lit(0).alias("part"), F.lit(0.0).alias("_no_label"))
    blocks = wide.WideRows(rows, design, "_no_label")
    if not len(blocks.parts):
        raise ValueError("no rows to fit")
    sums = blocks.sums()
    whole = sums.over(np.ones(1, bool))
    found = wide.sketched_axes(blocks, sums, np.ones(blocks.width), [0], min(k, blocks.width))
    total = (whole.xx - whole.x**2 / whole.n).clip(0).sum() / max(whole.n - 1, 1)
    return PrincipalComponents(design, found.axes, found.variances, float(total), found.bounds)
