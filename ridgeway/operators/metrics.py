"""Regression metrics as aggregates: one job, whatever the number of metrics.

A row counts if it has both a label and a prediction, for every metric alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def squared_error(label: str | Column, prediction: str | Column) -> Column:
    return F.pow(_col(label) - _col(prediction), F.lit(2.0))


def mse(label: str | Column, prediction: str | Column) -> Column:
    return F.avg(squared_error(label, prediction))


def rmse(label: str | Column, prediction: str | Column) -> Column:
    return F.sqrt(mse(label, prediction))


def mae(label: str | Column, prediction: str | Column) -> Column:
    """Mean absolute error."""
    return F.avg(F.abs(_col(prediction) - _col(label)))


def abs_mean_error(label: str | Column, prediction: str | Column) -> Column:
    """Absolute mean error (bias): positive and negative errors cancel."""
    error = _col(prediction) - _col(label)
    return F.abs(F.sum(error)) / F.nullif(F.count(error), F.lit(0))


def r2(label: str | Column, prediction: str | Column) -> Column:
    """Share of variance explained; null where the label does not vary.

    The total sum of squares is n·var_pop, which Spark updates around a running
    mean, so no second pass over the rows is needed to centre the label. Merged
    running means of equal numbers can differ in the last digit: whether the
    label varies is told by its bounds, not by that variance.
    """
    scored = F.when(_col(prediction).isNotNull(), _col(label))
    total = F.count(scored) * F.var_pop(scored)
    varies = F.min(scored) < F.max(scored)
    return F.when(varies, F.lit(1.0) - F.sum(squared_error(label, prediction)) / total)


def regression_metrics(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """All metrics for each group (or for the whole table)."""
    return df.groupBy(*by).agg(
        F.count(_col(prediction) - _col(label)).alias("n"),
        mse(label, prediction).alias("mse"),
        rmse(label, prediction).alias("rmse"),
        mae(label, prediction).alias("mae"),
        abs_mean_error(label, prediction).alias("abs_mean_error"),
        r2(label, prediction).alias("r2"),
    )


def best_by_score(scores: DataFrame, candidate: str, score: str) -> DataFrame:
    """Top-1 row by score; a tie goes to the smallest candidate, and NaN is no score."""
    known = F.when(~F.isnan(score), F.col(score))
    return scores.orderBy(F.desc_nulls_last(known), F.asc(candidate)).limit(1)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
