"""Ridge fits, scoring, cross-validation, comparison with Spark ML."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeway.operators import crossval, metrics, mllib
from ridgeway.operators.encode import assemble
from ridgeway.operators.joins import union_by_name
from ridgeway.operators.moments import Design, moments
from ridgeway.operators.orthogonal import fit_ridge_orthogonal
from ridgeway.operators.ridge import (
    RidgeRegression,
    alpha_to_regparam,
    fit_moments,
    fit_ridge,
    fit_ridge_grouped,
    only_moments,
)
from ridgeway.operators.split import random_split, with_fold
from ridgeway.queries import sql
from ridgeway.queries.registry import query
from ridgeway.queries.tables import LINE_KEYS, SPEC, lines, model_rows, significant
from ridgeway.sources.stage import reused

TWO = ("l_extendedprice", "l_discount")
ALPHA = 0.1


def train_and_test(spark, sf_dir):
    rows = lines(spark, sf_dir).select(*LINE_KEYS, "y", *TWO)
    return random_split(rows, LINE_KEYS, [0.7, 0.3])


_FIT = sql.two_feature_fit("train", str(ALPHA))
_TRAIN = f"WITH {sql.LINES}, train AS (SELECT * FROM lines WHERE is_train), fit AS ({_FIT})"


@query(f"""{_TRAIN}
SELECT {sql.significant('b0', 7)} AS intercept, {sql.significant('b1', 7)} AS slope_price,
       {sql.significant('b2', 7)} AS slope_discount FROM fit""")
def ridge_fit(spark, sf_dir):
    """The estimator on a vector column."""
    train, _ = train_and_test(spark, sf_dir)
    ridge = RidgeRegression(featuresCol="features", labelCol="y", alpha=ALPHA)
    theta = ridge.fit(assemble(train, TWO, "features")).coefficients
    frame = spark.createDataFrame(
        [tuple(float(t) for t in theta)], "intercept double, slope_price double, slope_discount double"
    )
    return frame.select(*(significant(c, 7).alias(c) for c in frame.columns))


_HOLED = """(SELECT * FROM train WHERE l_linenumber NOT IN (2, 3))"""


@query(f"""WITH {sql.LINES}, train AS (SELECT * FROM lines WHERE is_train),
fit AS ({sql.two_feature_fit(_HOLED, str(ALPHA))})
SELECT plan, {sql.significant('b0', 7)} AS intercept, {sql.significant('b1', 7)} AS slope_price,
       {sql.significant('b2', 7)} AS slope_discount FROM fit, (VALUES ('arrow'), ('native')) p(plan)""")
def ridge_fit_nulls(spark, sf_dir):
    """Rows with a null feature or label are skipped, by both plans alike."""
    train, _ = train_and_test(spark, sf_dir)
    holed = train.withColumns(
        {
            "l_extendedprice": F.when(F.col("l_linenumber") != 2, F.col("l_extendedprice")),
            "y": F.when(F.col("l_linenumber") != 3, F.col("y")),
        }
    )
    fits = [(p, fit_ridge(holed, TWO, "y", ALPHA, plan=p)) for p in ("arrow", "native")]
    rows = [(p, float(f.intercept), *map(float, f.slopes)) for p, f in fits]
    frame = spark.createDataFrame(rows, "plan string, intercept double, slope_price double, slope_discount double")
    return frame.select("plan", *(significant(c, 7).alias(c) for c in frame.columns[1:]))


@query(f"""WITH {sql.LINES}, far AS (SELECT l_extendedprice + 1e9 AS x, y FROM lines)
SELECT plan, {sql.significant('slope', 6)} AS slope, {sql.significant('mean', 9)} AS mean
FROM (SELECT regr_slope(y, x) AS slope, avg(x) AS mean FROM far), (VALUES ('arrow'), ('native')) p(plan)""")
def ridge_fit_offset(spark, sf_dir):
    """A feature far from zero keeps its slope, by both plans."""
    far = lines(spark, sf_dir).select((F.col("l_extendedprice") + 1e9).alias("x"), "y")
    rows = []
    for plan in ("arrow", "native"):
        found = only_moments(moments(far, Design(numericals=("x",)), "y", plan=plan))
        rows.append((plan, float(fit_moments(found, 0.0).slopes[0]), float(found.means[0])))
    frame = spark.createDataFrame(rows, "plan string, slope double, mean double")
    return frame.select("plan", significant("slope", 6).alias("slope"), significant("mean", 9).alias("mean"))


_FAR = {"A": "0", "N": "1e9", "R": "-3e6"}
_FAR_X = " ".join(f"WHEN l_returnflag = '{flag}' THEN {at} + l_quantity" for flag, at in _FAR.items())


@query(f"""WITH {sql.LINES}, far AS (
  SELECT l_returnflag, CASE {_FAR_X} END AS x, 3 * l_quantity + l_tax AS y FROM lines)
SELECT plan, l_returnflag, {sql.significant('slope', 6)} AS slope
FROM (SELECT l_returnflag, regr_slope(y, x) AS slope FROM far GROUP BY l_returnflag), (VALUES ('arrow'), ('native')) p(plan)""")
def ridge_fit_grouped_far(spark, sf_dir):
    """Groups that lie far apart each keep their slope, by both plans."""
    x = F.expr(f"CASE {_FAR_X.replace('1e9', '1e9D')} END")
    far = lines(spark, sf_dir).select("l_returnflag", x.alias("x"), (F.col("l_quantity") * 3 + F.col("l_tax")).alias("y"))
    fits = [
        fit_ridge_grouped(far, ["x"], "y", 0.0, by=["l_returnflag"], plan=p).withColumn("plan", F.lit(p))
        for p in ("arrow", "native")
    ]
    slopes = union_by_name(*fits).filter("term = 'x'")
    return slopes.select("plan", "l_returnflag", significant("coefficient", 6).alias("slope"))


_NEAR = """SELECT l_extendedprice AS x1, l_extendedprice * l_tax AS x2, y * (1 + l_tax) AS y FROM lines"""


@query(f"""WITH {sql.LINES}, near AS ({_NEAR}), fit AS ({sql.two_feature_fit('near', '0.0', x1='x1', x2='x2')})
SELECT {sql.significant('b0', 3)} AS intercept, {sql.significant('(b1 - b2 * 1e7)', 6)} AS slope_price,
       {sql.significant('(b2 * 1e7)', 6)} AS slope_near FROM fit""")
def ridge_fit_collinear(spark, sf_dir):
    """The price, and a feature that differs from it in the eighth digit; the twin takes their difference apart."""
    near = lines(spark, sf_dir).select(
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax") * 1e-7)).alias("near"),
        (F.col("y") * (1 + F.col("l_tax"))).alias("y"),
    )
    fit = fit_ridge_orthogonal(near, Design(numericals=("price", "near")), "y")
    rows = [(float(fit.intercept), *map(float, fit.slopes))]
    frame = spark.createDataFrame(rows, "intercept double, slope_price double, slope_near double")
    return frame.select(*(significant(c, 3 if c == "intercept" else 6).alias(c) for c in frame.columns))


def _system_sql(source: str, features: list[str], alpha: float) -> str:
    """Normal equations on centred columns, as one list of rows."""
    p = len(features)

    def moment(a: str, b: str) -> str:
        return f"covar_pop({a}, {b}) * count(*)"

    rows = [
        "[" + ", ".join(
            [moment(a, b) + (f" + {alpha}" if i == j else "") for j, b in enumerate(features)]
            + [moment(a, "y")]
        ) + "]"
        for i, a in enumerate(features)
    ]
    means = ", ".join(f"avg({c}) AS m{i + 1}" for i, c in enumerate(features))
    back = " - ".join(["my", *(f"m{i + 1} * (SELECT beta FROM solved WHERE pos = {i + 1})" for i in range(p))])
    terms = " UNION ALL ".join(
        f"SELECT {i + 1} AS position, '{c}' AS term, (SELECT beta FROM solved WHERE pos = {i + 1}) AS b"
        for i, c in enumerate(features)
    )
    return f"""
sys AS (SELECT 1 AS id, [{", ".join(rows)}] AS m FROM {source}),
means AS (SELECT avg(y) AS my, {means} FROM {source}),
{sql.ELIMINATION},
terms AS (SELECT 0 AS position, '(intercept)' AS term, {back} AS b FROM means UNION ALL {terms})"""


@query(f"""WITH RECURSIVE {sql.MODEL}, train AS (SELECT * FROM model WHERE is_train),
{_system_sql('train', sql.NUMERICALS, 1.0)}
SELECT position, term, {sql.significant('b', 6)} AS coefficient FROM terms""")
def ridge_coefficients(spark, sf_dir):
    """Five features, by name, the intercept first."""
    columns = [*LINE_KEYS, "y", *SPEC.numericals]
    train, _ = random_split(model_rows(spark, sf_dir).select(*columns), LINE_KEYS, [0.7, 0.3])
    table = fit_ridge(train, SPEC.numericals, "y", 1.0).coefficients(spark)
    return table.select("position", "term", significant("coefficient", 6).alias("coefficient"))


@query(f"""WITH {sql.LINES}, fit AS ({sql.two_feature_fit('lines', '0.5', 'l_returnflag, l_suppkey')})
SELECT l_returnflag, l_suppkey, '(intercept)' AS term, {sql.significant('b0', 6)} AS coefficient FROM fit
UNION ALL SELECT l_returnflag, l_suppkey, 'l_extendedprice', {sql.significant('b1', 6)} FROM fit
UNION ALL SELECT l_returnflag, l_suppkey, 'l_discount', {sql.significant('b2', 6)} FROM fit""")
def ridge_fit_grouped(spark, sf_dir):
    """One model per supplier and return flag, solved where the sums are."""
    fits = fit_ridge_grouped(lines(spark, sf_dir), TWO, "y", 0.5, by=["l_returnflag", "l_suppkey"])
    return fits.withColumn("coefficient", significant("coefficient", 6))


@query(f"""{_TRAIN}
SELECT {sql.KEYS}, round(b0 + b1 * l_extendedprice + b2 * l_discount, 2) AS prediction
FROM lines, fit WHERE NOT is_train""")
def predict_ridge(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    scored = fit_ridge(train, TWO, "y", ALPHA).predict(test)
    return scored.select(*LINE_KEYS, F.round("prediction", 2).alias("prediction"))


def _cv_sql() -> str:
    fits = " UNION ALL ".join(
        f"SELECT {a} AS alpha, {k} AS fold, f.* FROM ("
        + sql.two_feature_fit(f"(SELECT * FROM train WHERE fold <> {k})", str(a))
        + ") f"
        for a in (0.01, 0.1, 1.0)
        for k in range(5)
    )
    return f"""WITH {sql.LINES}, train AS (SELECT * FROM lines WHERE is_train), fits AS ({fits}),
scores AS (
  SELECT CAST(alpha AS DOUBLE) AS alpha, CAST(fold AS INTEGER) AS fold,
         1 - sum((y - b0 - b1 * l_extendedprice - b2 * l_discount) ** 2) / (count(*) * var_pop(y)) AS r2
  FROM train JOIN fits USING (fold) GROUP BY alpha, fold)"""


def _cv_scores(spark, sf_dir):
    train, _ = train_and_test(spark, sf_dir)
    return crossval.cross_validate(with_fold(train, LINE_KEYS, 5), TWO, "y")


@query(f"{_cv_sql()} SELECT alpha, fold, round(r2, 9) AS r2 FROM scores")
def cv_scores(spark, sf_dir):
    """R² of every penalty on every fold, from one aggregation."""
    scores = _cv_scores(spark, sf_dir)
    return scores.select("alpha", "fold", F.round("r2", 9).alias("r2"))


@query(f"""{_cv_sql()}
SELECT alpha, round(avg(r2), 9) AS mean_r2 FROM scores GROUP BY alpha
ORDER BY avg(r2) DESC, alpha LIMIT 1""")
def select_alpha(spark, sf_dir):
    best = crossval.select_alpha(_cv_scores(spark, sf_dir))
    return best.select("alpha", F.round("mean_r2", 9).alias("mean_r2"))


def _both_fits(spark, sf_dir):
    """Ridge and Spark's own model on the same training rows, which are prepared once."""
    train, test = train_and_test(spark, sf_dir)
    with reused(train.select("y", *TWO)) as rows:
        stats = rows.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("y").alias("dev")).first()
        penalty = alpha_to_regparam(ALPHA, stats["n"], stats["dev"])
        vectors = assemble(rows, TWO, "features")
        other = mllib.linear_regression(vectors, "y", penalty, solver="normal")
        return fit_ridge(rows, TWO, "y", ALPHA), other, test


@query(f"""{_TRAIN}
SELECT '(intercept)' AS term, {sql.significant('b0', 5)} AS coefficient FROM fit
UNION ALL SELECT 'l_extendedprice', {sql.significant('b1', 5)} FROM fit
UNION ALL SELECT 'l_discount', {sql.significant('b2', 5)} FROM fit""")
def mllib_linear_regression(spark, sf_dir):
    """Spark's LinearRegression at the converted penalty finds the same coefficients."""
    _, model, _ = _both_fits(spark, sf_dir)
    rows = [("(intercept)", float(model.intercept))]
    rows += [(t, float(b)) for t, b in zip(TWO, model.coefficients)]
    frame = spark.createDataFrame(rows, "term string, coefficient double")
    return frame.withColumn("coefficient", significant("coefficient", 5))


@query(f"""{_TRAIN}, scored AS (
  SELECT 1 - sum((y - b0 - b1 * l_extendedprice - b2 * l_discount) ** 2) / (count(*) * var_pop(y)) AS r2,
         count(*) AS n
  FROM lines, fit WHERE NOT is_train)
SELECT 'ridge' AS model, n, round(r2, 8) AS r2 FROM scored
UNION ALL SELECT 'mllib', n, round(r2, 8) FROM scored""")
def model_comparison(spark, sf_dir):
    """Both models scored on the test rows in one aggregation."""
    ridge, other, test = _both_fits(spark, sf_dir)
    scored = ridge.predict(test, "ridge")
    scored = other.setPredictionCol("mllib").transform(assemble(scored, TWO, "features"))
    long = scored.unpivot(["y"], ["ridge", "mllib"], "model", "prediction")
    both = metrics.regression_metrics(long, "y", "prediction", ["model"])
    return both.select("model", "n", F.round("r2", 8).alias("r2"))
