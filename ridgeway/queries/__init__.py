"""The registered queries: each operator run on the given tables, with its SQL twin."""

from ridgeway.queries import evaluation, experiments, features, fits, preparation, splits, sums
from ridgeway.queries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
_MODULES = (preparation, splits, evaluation, sums, features, fits, experiments)
