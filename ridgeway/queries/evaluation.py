"""Regression metrics of a fixed prediction: the list price less the mean discount."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeway.operators import metrics
from ridgeway.queries import sql
from ridgeway.queries.registry import query
from ridgeway.queries.tables import LINE_KEYS, lines, significant

_SCORED = f"{sql.LINES}, scored AS (SELECT *, l_extendedprice * 0.95 AS prediction FROM lines)"
_R2 = "1 - sum((y - prediction) ** 2) / nullif(count(*) * var_pop(y), 0)"
_METRICS = f"""count(*) AS n,
  {sql.significant('avg((y - prediction) ** 2)')} AS mse,
  {sql.significant('sqrt(avg((y - prediction) ** 2))')} AS rmse,
  {sql.significant('avg(abs(y - prediction))')} AS mae,
  {sql.significant('(abs(sum(prediction - y)) / count(*))', 7)} AS abs_mean_error,
  round({_R2}, 9) AS r2"""


def _scored(spark, sf_dir):
    return lines(spark, sf_dir).withColumn("prediction", F.col("l_extendedprice") * 0.95)


def _rounded(df, *by):
    return df.select(
        *by,
        "n",
        significant("mse").alias("mse"),
        significant("rmse").alias("rmse"),
        significant("mae").alias("mae"),
        significant("abs_mean_error", 7).alias("abs_mean_error"),
        F.round("r2", 9).alias("r2"),
    )


@query(f"""WITH {_SCORED}
SELECT {sql.KEYS}, round((y - prediction) * (y - prediction), 4) AS squared_error FROM scored""")
def squared_error_rows(spark, sf_dir):
    error = F.round(metrics.squared_error("y", "prediction"), 4)
    return _scored(spark, sf_dir).select(*LINE_KEYS, error.alias("squared_error"))


@query(f"WITH {_SCORED} SELECT {_METRICS} FROM scored")
def metrics_regression(spark, sf_dir):
    return _rounded(metrics.regression_metrics(_scored(spark, sf_dir), "y", "prediction"))


@query(f"WITH {_SCORED} SELECT l_returnflag, l_linenumber, {_METRICS} FROM scored GROUP BY ALL")
def metrics_by_group(spark, sf_dir):
    by = ["l_returnflag", "l_linenumber"]
    return _rounded(metrics.regression_metrics(_scored(spark, sf_dir), "y", "prediction", by), *by)


@query(f"""WITH {_SCORED}
SELECT l_suppkey, round({_R2}, 9) AS r2, round(1 - sum((1 - 1.0) ** 2) / nullif(0, 0), 9) AS r2_constant
FROM scored GROUP BY l_suppkey""")
def r2_score(spark, sf_dir):
    """R² per supplier, and of a label that does not vary: null."""
    constant = metrics.r2(F.lit(1.0), F.lit(1.0))
    return _scored(spark, sf_dir).groupBy("l_suppkey").agg(
        F.round(metrics.r2("y", "prediction"), 9).alias("r2"),
        F.round(constant, 9).alias("r2_constant"),
    )


@query(f"""WITH {_SCORED}, holed AS (
  SELECT l_returnflag, CASE WHEN l_linenumber = 3 THEN NULL ELSE y END AS y,
         CASE WHEN l_linenumber = 2 THEN NULL ELSE prediction END AS prediction FROM scored)
SELECT l_returnflag, {_METRICS} FROM holed WHERE y IS NOT NULL AND prediction IS NOT NULL GROUP BY l_returnflag""")
def metrics_with_nulls(spark, sf_dir):
    """Rows without label or prediction count for no metric."""
    holed = _scored(spark, sf_dir).select(
        "l_returnflag",
        F.when(F.col("l_linenumber") != 3, F.col("y")).alias("y"),
        F.when(F.col("l_linenumber") != 2, F.col("prediction")).alias("prediction"),
    )
    return _rounded(metrics.regression_metrics(holed, "y", "prediction", ["l_returnflag"]), "l_returnflag")
