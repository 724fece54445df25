"""Regression analytics on Spark tables.

The library prepares modelling tables (prune, join, null handling), splits them
reproducibly, and fits ridge regression from additive second moments, so that
cross-validation over a grid of penalties costs one distributed aggregation.
"""

__version__ = "0.1.0"
