from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from ridgeway.operators import metrics


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(1)
    y = rng.normal(100, 20, 400)
    p = y + rng.normal(1, 5, 400)
    rows = [(float(a), float(b), int(i % 3)) for i, (a, b) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "y double, p double, g int"), y, p


def test_metrics_match_numpy(scored):
    df, y, p = scored
    found = metrics.regression_metrics(df, "y", "p").first()
    assert found.n == 400
    assert found.mse == pytest.approx(((y - p) ** 2).mean())
    assert found.rmse == pytest.approx(((y - p) ** 2).mean() ** 0.5)
    assert found.mae == pytest.approx(np.abs(y - p).mean())
    assert found.abs_mean_error == pytest.approx(abs((p - y).mean()))
    assert found.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_r2_matches_spark(scored):
    df, _, _ = scored
    evaluator = RegressionEvaluator(labelCol="y", predictionCol="p", metricName="r2")
    assert df.agg(metrics.r2("y", "p")).first()[0] == pytest.approx(evaluator.evaluate(df))


def test_groups(scored):
    df, y, p = scored
    g = np.arange(400) % 3
    for r in metrics.regression_metrics(df, "y", "p", ["g"]).collect():
        assert r.mse == pytest.approx(((y - p)[g == r.g] ** 2).mean())


def test_constant_label_has_no_r2(spark):
    df = spark.createDataFrame([(0.1, 1.0), (0.1, 2.0), (0.1, 0.5)], "y double, p double")
    assert df.agg(metrics.r2("y", "p")).first()[0] is None


def test_best_score_prefers_the_smaller_candidate(spark):
    df = spark.createDataFrame([(1.0, 0.5), (0.1, 0.7), (0.01, 0.7)], "alpha double, s double")
    assert metrics.best_by_score(df, "alpha", "s").first().alpha == 0.01


def test_rows_without_label_or_prediction_do_not_count(spark):
    rows = [(1.0, 1.1), (2.0, 1.8), (4.0, 4.5)]
    gaps = [(None, 3.0), (None, 9.0), (5.0, None), (None, None)]
    whole, holed = (spark.createDataFrame(r, "y double, p double") for r in (rows, rows + gaps))
    assert metrics.regression_metrics(holed, "y", "p").first() == metrics.regression_metrics(whole, "y", "p").first()


def test_nan_is_no_score(spark):
    df = spark.createDataFrame([(1.0, float("nan")), (0.1, 0.7), (0.01, None)], "alpha double, s double")
    assert metrics.best_by_score(df, "alpha", "s").first().alpha == 0.1


@pytest.mark.parametrize("rows", [48, 49, 98, 103, 107, 161])
def test_a_constant_label_has_no_r2_in_any_cut(spark, rows):
    df = spark.range(0, 2 * rows, 1, 2).select(F.lit(1.0).alias("y"), (F.lit(1.0) + F.col("id") % 2 / 10).alias("p"), F.lit(7).alias("g"))
    assert df.agg(metrics.r2("y", "p")).first()[0] is None
    assert df.groupBy("g").agg(metrics.r2("y", "p").alias("r")).first().r is None
    assert metrics.regression_metrics(df, "y", "p").first().r2 is None
