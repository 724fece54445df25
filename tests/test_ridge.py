from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ridgeway.operators import ridge as ops
from ridgeway.operators import solvers, wide
from ridgeway.operators.crossval import best_alpha, cross_validate, mean_scores, score_folds
from ridgeway.operators.metrics import r2
from ridgeway.operators.moments import Design, Moments, moments
from ridgeway.operators.pca import fit_pca

COLUMNS = ("a", "b", "c")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.normal([5, -3, 1000], [1, 2, 30], (600, 3))
    y = 7 + x @ [1.5, -2.0, 0.1] + rng.normal(0, 1, 600)
    fold = np.arange(600) % 5
    rows = [(*map(float, r), float(t), int(f)) for r, t, f in zip(x, y, fold)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double, fold int")
    vectors = VectorAssembler(inputCols=list(COLUMNS), outputCol="features").transform(df)
    return vectors.cache(), x, y, fold


def closed_form(x, y, alpha):
    """(Z'Z + αA)⁻¹Z'y with the intercept's entry of A zero."""
    z = np.column_stack([np.ones(len(x)), x])
    penalty = alpha * np.eye(z.shape[1])
    penalty[0, 0] = 0
    return np.linalg.solve(z.T @ z + penalty, z.T @ y)


@pytest.mark.parametrize("alpha", [0.0, 0.01, 1.0, 100.0])
def test_fit_matches_the_normal_equations(data, alpha):
    df, x, y, _ = data
    fit = ops.fit_ridge(df, COLUMNS, "y", alpha)
    assert np.allclose([fit.intercept, *fit.slopes], closed_form(x, y, alpha), rtol=1e-7)


def test_a_huge_penalty_leaves_the_mean(data):
    df, _, y, _ = data
    fit = ops.fit_ridge(df, COLUMNS, "y", 1e15)
    assert np.allclose(fit.slopes, 0, atol=1e-6) and fit.intercept == pytest.approx(y.mean(), rel=1e-6)


def test_a_negative_penalty_is_refused(data):
    with pytest.raises(ValueError, match="negative"):
        ops.fit_ridge(data[0], COLUMNS, "y", -1.0)


def test_no_rows_is_an_error(data):
    with pytest.raises(ValueError, match="no rows"):
        ops.fit_ridge(data[0].filter("false"), COLUMNS, "y", 1.0)


def test_collinear_columns_without_penalty_get_the_shortest_solution(spark):
    df = spark.range(50).select(
        F.col("id").cast("double").alias("a"), F.col("id").cast("double").alias("b"), (F.col("id") * 2.0).alias("y")
    )
    fit = ops.fit_ridge(df, ("a", "b"), "y", 0.0)
    assert np.allclose(fit.slopes, [1.0, 1.0])


def test_prediction_is_native_and_leaves_features_alone(data):
    df, x, y, _ = data
    scored = ops.fit_ridge(df, COLUMNS, "y", 1.0).predict(df)
    text = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
    theta = closed_form(x, y, 1.0)
    want = theta[0] + x @ theta[1:]
    assert np.allclose([r.prediction for r in scored.collect()], want, rtol=1e-9)
    assert scored.columns == [*df.columns, "prediction"]


def test_moments_score_like_residuals(data):
    df, *_ = data
    m = moments(df, Design(numericals=COLUMNS), "y").collect()[()]
    fit = ops.fit_moments(m, 10.0)
    direct = fit.predict(df).agg(r2("y", "prediction")).first()[0]
    assert ops.r2_from_moments(m, fit) == pytest.approx(direct, abs=1e-12)


def test_estimator_in_a_pipeline(data, tmp_path):
    df, x, y, _ = data
    assembler = VectorAssembler(inputCols=list(COLUMNS), outputCol="v")
    ridge = ops.RidgeRegression(featuresCol="v", labelCol="y", predictionCol="p", alpha=2.0)
    model = Pipeline(stages=[assembler, ridge]).fit(df)
    theta = closed_form(x, y, 2.0)
    assert np.allclose(model.stages[-1].coefficients, theta, rtol=1e-8)
    scored = model.transform(df).select("p", "v").collect()
    assert np.allclose([r.p for r in scored], theta[0] + x @ theta[1:], rtol=1e-9)
    assert len(scored[0].v) == 3
    path = f"{tmp_path}/model"
    model.stages[-1].write().save(path)
    again = ops.RidgeRegressionModel.load(path)
    assert np.array_equal(again.coefficients, model.stages[-1].coefficients)
    assert again.getFeaturesCol() == "v" and again.getAlpha() == 2.0


def test_wide_vectors_are_fitted_iteratively(data, monkeypatch):
    df, x, y, _ = data
    monkeypatch.setattr(ops, "MAX_WIDTH", 2)
    model = ops.RidgeRegression(featuresCol="features", labelCol="y", alpha=50.0).fit(df)
    assert np.allclose(model.coefficients, closed_form(x, y, 50.0), rtol=1e-5)


@pytest.mark.parametrize("solver, ddof", [("normal", 0), ("l-bfgs", 1)])
def test_spark_finds_the_same_model_at_the_converted_penalty(data, solver, ddof):
    df, x, y, _ = data
    penalty = ops.alpha_to_regparam(20.0, len(y), y.std(ddof=ddof))
    other = LinearRegression(
        labelCol="y", regParam=penalty, elasticNetParam=0.0, standardization=False, solver=solver, tol=1e-12, maxIter=500
    ).fit(df)
    theta = closed_form(x, y, 20.0)
    assert np.allclose([other.intercept, *other.coefficients], theta, rtol=1e-5)


def test_grouped_fits(data, spark):
    df, x, y, fold = data
    found = ops.fit_ridge_grouped(df, COLUMNS, "y", 0.5, by=["fold"]).collect()
    assert len(found) == 5 * 4
    for k in range(5):
        theta = {r.term: r.coefficient for r in found if r.fold == k}
        want = closed_form(x[fold == k], y[fold == k], 0.5)
        assert np.allclose([theta["(intercept)"], *(theta[c] for c in COLUMNS)], want, rtol=1e-6)


def test_a_group_of_one_row_predicts_itself(spark):
    df = spark.createDataFrame([("u", 3.0, 8.0)], "g string, a double, y double")
    for alpha in (0.0, 0.1):
        rows = ops.fit_ridge_grouped(df, ["a"], "y", alpha, by=["g"]).collect()
        assert {r.term: r.coefficient for r in rows} == {"(intercept)": 8.0, "a": 0.0}


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 8), st.integers(2, 60), st.sampled_from([1e-3, 0.1, 1.0, 50.0]), st.integers(0, 10**6))
def test_the_gradient_vanishes(p, n, alpha, seed):
    rng = np.random.default_rng(seed)
    x, y = rng.normal(size=(n, p)), rng.normal(size=n)
    z = np.column_stack([np.ones(n), x, y])
    fit = ops.fit_moments(Moments(tuple(f"x{i}" for i in range(p)), z.T @ z), alpha)
    residual = y - fit.intercept - x @ fit.slopes
    assert abs(residual.sum()) < 1e-8 * n
    assert np.allclose(x.T @ residual, alpha * fit.slopes, atol=1e-7 * n)


@settings(max_examples=20, deadline=None)
@given(st.integers(1, 6), st.integers(0, 10**6))
def test_a_full_basis_rotates_nothing(p, seed):
    """Ridge on all principal components is ridge on the columns."""
    rng = np.random.default_rng(seed)
    x, y = rng.normal(size=(50, p)), rng.normal(size=50)
    z = np.column_stack([np.ones(50), x, y])
    m = Moments(tuple(f"x{i}" for i in range(p)), z.T @ z)
    axes, _ = solvers.principal_axes(m.covariance, p)
    assert np.allclose(ops.fit_moments(m, 0.7, axes).slopes, ops.fit_moments(m, 0.7).slopes)


def test_cross_validation_equals_refitting(data):
    df, x, y, fold = data
    scores = {(r.alpha, r.fold): r.r2 for r in cross_validate(df, COLUMNS, "y").collect()}
    assert len(scores) == 15
    for (alpha, k), score in scores.items():
        theta = closed_form(x[fold != k], y[fold != k], alpha)
        xv, yv = x[fold == k], y[fold == k]
        rss = ((yv - theta[0] - xv @ theta[1:]) ** 2).sum()
        assert score == pytest.approx(1 - rss / ((yv - yv.mean()) ** 2).sum(), abs=1e-10)


def test_a_fold_without_variance_does_not_count(spark):
    rows = [(0, float(i), 2.0 * i + (i % 2)) for i in range(10)] + [(1, float(i), 5.5) for i in range(5)]
    df = spark.createDataFrame(rows + [(2, float(i), 2.0 * i) for i in range(9)], "fold int, a double, y double")
    per_fold = {k[0]: m for k, m in moments(df, Design(numericals=("a",)), "y", by=["fold"]).collect().items()}
    scores = score_folds(per_fold, [0.1])
    assert [s for _, k, s in scores if k == 1] == [None]
    assert np.isfinite(mean_scores(scores)[0.1])


def test_ties_go_to_the_smallest_penalty():
    assert best_alpha({1.0: 0.5, 0.1: 0.5, 0.01: 0.4}) == 0.1


def test_a_basis_rule_is_applied_per_training_set(data):
    df, *_ = data
    per_fold = {k[0]: m for k, m in moments(df, Design(numericals=COLUMNS), "y", by=["fold"]).collect().items()}
    seen = []
    score_folds(per_fold, [1.0], lambda m: seen.append(m.n) or 1 / m.std)
    assert seen == [480.0] * 5


def test_axes_match_spark(data):
    from pyspark.ml.feature import PCA

    df, *_ = data
    mine = fit_pca(df, 2, numericals=COLUMNS)
    theirs = PCA(k=2, inputCol="features", outputCol="z").fit(df)
    axes = theirs.pc.toArray()
    signs = np.sign((axes * mine.axes).sum(axis=0))
    assert np.allclose(mine.axes, axes * signs, atol=1e-9)
    assert np.allclose(mine.variances / mine.total_variance, theirs.explainedVariance.toArray())
    scores = np.array([[r.pc1, r.pc2] for r in mine.transform(df).collect()])
    other = np.array([r.z.toArray() for r in theirs.transform(df).collect()])
    assert np.allclose(scores, other * signs, atol=1e-8)
    assert (mine.axes[np.abs(mine.axes).argmax(axis=0), [0, 1]] > 0).all()
    assert fit_pca(df, 9, numericals=COLUMNS).k == 3


def test_nan_scores_never_win():
    nan = float("nan")
    means = mean_scores([(0.1, 0, 0.5), (0.1, 1, nan), (1.0, 0, nan), (2.0, 0, 0.4)])
    assert means[0.1] == 0.5 and best_alpha(means) == 0.1
    assert best_alpha({0.1: nan, 1.0: 0.2}) == 1.0
    m = Moments(("a",), np.array([[2.0, nan, 1.0], [nan, nan, nan], [1.0, nan, 1.0]]))
    assert ops.r2_from_moments(m, ops.LinearFit(("a",), 0.0, np.array([1.0]))) is None


def test_prediction_of_thousands_of_terms(spark):
    from ridgeway.functions.linear import linear_column

    df = spark.range(3).select(F.col("id").cast("double").alias("x"))
    score = linear_column(1.0, [(F.col("x"), float(i % 5 + 1)) for i in range(8000)])
    assert [r[0] for r in df.select(score).collect()] == [1.0, 24001.0, 48001.0]


def test_grouped_fits_of_many_features(spark):
    import time

    rng = np.random.default_rng(3)
    x = rng.normal(1e6, 3, (1000, 60))
    y = (x - 1e6) @ np.arange(60) + rng.normal(0, 0.1, 1000)
    names = [f"x{i}" for i in range(60)]
    rows = [(*map(float, r), float(t), i % 5) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + ", y double, g int").cache()
    df.count()
    start = time.perf_counter()
    found = ops.fit_ridge_grouped(df, names, "y", 0.5, ["g"]).collect()
    assert time.perf_counter() - start < 20  # seconds; alone on a machine it takes about one
    by_group = {(r.g, r.term): r.coefficient for r in found}
    for g in range(5):
        want = closed_form(x[g::5] - 1e6, y[g::5], 0.5)
        assert np.allclose([by_group[g, n] for n in names], want[1:], rtol=1e-6)


def collinear_one_hot(spark):
    """Two one-hot columns where the second nearly repeats the first, and a shared level."""
    rng = np.random.default_rng(6)
    n = 20_000
    g = rng.integers(0, 30, n)
    h = np.where(rng.random(n) < 0.97, g, rng.integers(0, 30, n))
    x = rng.normal(size=n) + g / 10
    y = x + np.sin(g) + 0.1 * rng.normal(size=n)
    rows = [(int(a), int(b), float(c), float(t), int(i % 5)) for i, (a, b, c, t) in enumerate(zip(g, h, x, y))]
    df = spark.createDataFrame(rows, "g int, h int, x double, y double, part int").repartition(4)
    labels = {c: tuple(str(i) for i in range(30)) for c in ("g", "h")}
    return df, Design(numericals=("x",), categoricals=("g", "h"), labels=labels)


def test_the_sketch_saves_passes(spark, monkeypatch):
    df, design = collinear_one_hot(spark)
    systems = [wide.System(a, f) for a in (0.1, 1.0) for f in (0, 1, None)]
    rows = wide.WideRows(df, design, "y")
    sums = rows.sums()
    scale = wide.scales(sums, np.ones(5, bool))
    slopes, _ = wide.solve(rows, sums, scale, systems, range(5))
    assert rows.products <= 20
    whole = moments(df, design, "y").collect()[()]
    std = np.diag(np.divide(1.0, whole.std, out=np.zeros(whole.p), where=whole.std > 0))
    assert np.allclose(slopes[:, 2], ops.fit_moments(whole, 0.1, std).slopes, atol=1e-6)
    monkeypatch.setattr(wide, "MOST_PASSES", 20)
    with pytest.raises(ArithmeticError, match="convergence"):
        wide.solve(rows, sums, scale, systems, range(5), axes=0)


def test_a_sketch_takes_two_passes_and_bounds_its_error(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 6)) @ rng.normal(size=(6, 60)) * 3 + 0.01 * rng.normal(size=(500, 60)) + 50
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(3)
    want = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    counted = []
    product = wide.WideRows.product
    monkeypatch.setattr(wide.WideRows, "product", lambda self, *a: counted.append(1) or product(self, *a))
    found = fit_pca(df, 5, arrays=[("v", 60)], method="sketch")
    assert len(counted) == 2 and found.k == 5
    off = np.abs(found.variances[:, None] - want).min(axis=1)
    assert (off <= found.bounds + 1e-9).all() and np.allclose(found.variances, want[:5], rtol=1e-5)
    assert found.total_variance == pytest.approx(want.sum(), rel=1e-9)
    assert np.allclose(np.abs(found.axes.T @ fit_pca(df, 5, arrays=[("v", 60)]).axes), np.eye(5), atol=1e-3)


def test_principal_components_at_any_width(spark, monkeypatch):
    df = spark.createDataFrame([([float(i), 2.0 * i, 5.1],) for i in range(40)], "v array<double>")
    want = fit_pca(df, 3, arrays=[("v", 3)])
    monkeypatch.setattr("ridgeway.operators.pca.MAX_WIDTH", 2)
    found = fit_pca(df, 9, arrays=[("v", 3)])
    assert found.variances[0] == pytest.approx(want.variances[0]) and np.allclose(found.variances[1:], 0.0, atol=1e-9)
    constant = fit_pca(df.select(F.array(F.lit(1.5), F.lit(2.5)).alias("v")), 1, arrays=[("v", 2)], method="sketch")
    assert constant.variances.tolist() == [0.0] and constant.total_variance == 0.0
    with pytest.raises(ValueError, match="method"):
        fit_pca(df, 1, arrays=[("v", 3)], method="other")
    with pytest.raises(ValueError, match="no rows"):
        fit_pca(df.limit(0), 1, arrays=[("v", 3)], method="sketch")


def test_a_wide_estimator_of_columns_of_any_scale(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4)) * [1e-3, 1.0, 1e4, 0.0] + [0, 1e6, 0, 5.1]
    y = x @ [1e3, 1.0, 1e-4, 0.0] + rng.normal(size=300)
    df = spark.createDataFrame([(r.tolist(), float(t)) for r, t in zip(x, y)], "v array<double>, y double")
    want = ops.RidgeRegression(featuresCol="v", labelCol="y", alpha=2.0).fit(df).coefficients
    monkeypatch.setattr(ops, "MAX_WIDTH", 2)
    found = ops.RidgeRegression(featuresCol="v", labelCol="y", alpha=2.0).fit(df).coefficients
    assert np.allclose(found[1:], want[1:], rtol=1e-6, atol=1e-12) and found[0] == pytest.approx(want[0], rel=1e-6)
    monkeypatch.setattr(wide, "MOST_PASSES", 1)
    monkeypatch.setattr(wide, "PRECONDITIONER_AXES", 0)
    with pytest.raises(ArithmeticError, match="convergence"):
        wide.solve(*(lambda r: (r, r.sums(), np.ones(4), [wide.System(2.0, None)], [0], 0))(wide.WideRows(df.withColumn("part", F.lit(0)), Design(arrays=(("v", 4),)), "y")))


def test_a_path_of_penalties_is_one_decomposition(monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 6))
    x[:, 5] = x[:, 4]
    spread, cross = x.T @ x, x.T @ rng.normal(size=50)
    alphas = [0.0, *np.logspace(-3, 3, 40)]
    counted, eigh = [], np.linalg.eigh
    monkeypatch.setattr(solvers.np.linalg, "eigh", lambda m: counted.append(1) or eigh(m))
    found = solvers.ridge_path(spread, cross, alphas)
    assert len(counted) == 1
    for alpha, slopes in zip(alphas, found):
        assert np.allclose(slopes, solvers.ridge_slopes(spread, cross, alpha), rtol=1e-8, atol=1e-10)
