"""Row filters and null handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def drop_null_label(df: DataFrame, label: str) -> DataFrame:
    """Keep labelled rows. ``IS NOT NULL`` reaches the file scan; ``dropna`` would not."""
    return df.filter(F.col(label).isNotNull())


def fill_nulls(df: DataFrame, columns: Sequence[str], value: float = 0) -> DataFrame:
    """Replace nulls in numeric columns; a non-numeric column is an error, not a no-op."""
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in columns if c not in types]
    if missing:
        raise ValueError(f"columns missing from the table: {missing}")
    wrong = [c for c in columns if not isinstance(types[c], NumericType)]
    if wrong:
        raise ValueError(f"columns are not numeric: {wrong}")
    return df.fillna(value, list(columns))


def non_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, non_null) for each column, from one aggregation."""
    if not columns:
        raise ValueError("no columns given")
    counted = df.agg(*(F.count(F.col(c)).alias(c) for c in columns))
    return counted.unpivot([], list(columns), "column_name", "non_null")
