"""Linear forms as native column expressions, and matrix products per Arrow batch."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def linear_column(intercept: float, terms: Sequence[tuple[Column, float]]) -> Column:
    """``intercept + Σ weight·column``; zero weights are left out.

    Sums are paired, so the expression is as deep as the logarithm of its length:
    a chain of some hundred terms overflows the planner's stack.
    """
    parts = [F.lit(float(intercept)), *(c * F.lit(float(w)) for c, w in terms if w != 0.0)]
    while len(parts) > 1:
        pairs = [a + b for a, b in zip(parts[::2], parts[1::2])]
        parts = pairs + parts[len(parts) // 2 * 2 :]
    return parts[0]


def dot(values: Column, weights: Sequence[float]) -> Column:
    """Inner product of an ``array<double>`` column with fixed weights."""
    fixed = F.array(*(F.lit(float(w)) for w in weights))
    products = F.zip_with(values, fixed, lambda x, w: x * w)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def projection(axes: np.ndarray):
    """A function of a vector column: its products with every axis; null stays null."""

    @F.pandas_udf("array<double>")
    def project(vectors: pd.Series) -> pd.Series:
        known = vectors.notna().to_numpy()
        out = np.full(len(vectors), None, object)
        if known.any():
            rows = np.stack(vectors[known].to_numpy()).astype(float) @ axes
            out[np.flatnonzero(known)] = np.fromiter(iter(rows), object, len(rows))
        return pd.Series(out)

    return project
