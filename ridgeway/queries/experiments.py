"""The five experiments on order lines, and the run log."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ridgeway.operators.metrics import regression_metrics
from ridgeway.operators.ridge import fit_ridge
from ridgeway.operators.rows import drop_null_label, fill_nulls
from ridgeway.operators.split import random_split, split_index
from ridgeway.plans.experiment import PRESETS, run_experiment
from ridgeway.queries import sql
from ridgeway.queries.registry import query
from ridgeway.queries.tables import LINE_KEYS, SPEC, lines, model_rows, table
from ridgeway.sources.metrics_log import MetricsLog
from ridgeway.sources.stage import new_folder

# the presets draw from 150 categorical columns; these tables have 6
FEWER = {"experiment2": {"categoricals": 1}, "experiment3": {"categoricals": 4}, "experiment4": {"pca_k": 10}}


def _experiment_sql(
    categoricals: int,
    alphas: tuple[float, ...] = (0.01, 0.1, 1.0),
    components: int | None = None,
    predictions: bool = False,
    by_order: bool = False,
) -> str:
    """An experiment in SQL: one matrix per part, axes by powers, fits by elimination.

    Its scores, or with ``predictions`` what the final fit says of the test rows. ``by_order``
    takes the order's key as one more ordinal.
    """
    dense = [*sql.NUMERICALS, "line_rank", "priority_rank", *(["order_rank"] if by_order else [])]
    label = 9999
    dense_cells = "\n  UNION ALL ".join(
        f"SELECT rid, part, {i + 1} AS pos, CAST({c} AS DOUBLE) AS x FROM ranked" for i, c in enumerate(dense)
    )
    values = " UNION ALL ".join(
        f"SELECT rid, part, '{c}' AS name, {c} AS v FROM rows" for c in sql.CATEGORICALS
    )
    names = ", ".join(f"('{c}')" for c in sql.CATEGORICALS)
    grid = ", ".join(f"({a})" for a in alphas)
    if components is None:
        basis = "basis AS MATERIALIZED (SELECT i, i AS comp, 1.0 / d AS w FROM scale)"
    else:
        basis = f"""correlation_rows AS (
  SELECT c.i, list(c.s / (n - 1) / a.d / b.d ORDER BY c.j) AS row
  FROM centred c JOIN counts USING (id) JOIN scale a ON a.i = c.i JOIN scale b ON b.i = c.j
  WHERE c.id = 5 GROUP BY c.i
),
correlation AS (SELECT list(row ORDER BY i) AS m FROM correlation_rows),
{sql.principal_axes('correlation', components)},
loadings AS (SELECT comp, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM axes),
basis AS MATERIALIZED (
  SELECT i, CAST(comp AS BIGINT) AS comp, x / d AS w
  FROM loadings JOIN (SELECT i, d, row_number() OVER (ORDER BY i) AS place FROM scale) USING (place)
)"""
    cv = "SELECT 'cv' AS step, alpha, round(mean_r2, 9) AS r2 FROM means UNION ALL" if len(alphas) > 1 else ""
    result = f"""{cv}
SELECT model AS step, alpha, round(r2, 9) AS r2 FROM scores JOIN best USING (alpha) WHERE id = 5"""
    if predictions:
        result = f""", final AS (SELECT i, b FROM slopes WHERE id = 5 AND model = 'ridge'),
base AS (
  SELECT any_value(my.mean) - sum(b * a.mean) AS b0
  FROM final JOIN averages a ON a.id = 5 AND a.i = final.i, averages my WHERE my.id = 5 AND my.i = {label}
)
SELECT {sql.KEYS}, round(any_value(b0) + sum(c.x * b), 3) AS prediction
FROM ranked JOIN cells c ON c.rid = ranked.rid JOIN final ON final.i = c.pos, base
WHERE ranked.part = -1 GROUP BY ranked.rid, {sql.KEYS}"""
    return f"""WITH RECURSIVE {sql.MODEL},
rows AS MATERIALIZED (
  SELECT *, CASE WHEN is_train THEN fold ELSE -1 END AS part, row_number() OVER () AS rid FROM model
),
train AS (SELECT * FROM rows WHERE part >= 0),
line_ranks AS ({sql.ranked_labels('train', 'l_linenumber')}),
priority_ranks AS ({sql.ranked_labels('train', 'o_orderpriority')}),
order_ranks AS MATERIALIZED ({sql.ranked_labels('train', 'l_orderkey')}),
ranked AS MATERIALIZED (
  SELECT rows.*, coalesce(a.r, (SELECT count(*) FROM line_ranks)) AS line_rank,
         coalesce(b.r, (SELECT count(*) FROM priority_ranks)) AS priority_rank,
         coalesce(c.r, (SELECT count(*) FROM order_ranks)) AS order_rank
  FROM rows LEFT JOIN line_ranks a ON l_linenumber::VARCHAR = a.v
  LEFT JOIN priority_ranks b ON o_orderpriority = b.v
  LEFT JOIN order_ranks c ON l_orderkey::VARCHAR = c.v
),
chosen AS (SELECT name FROM (VALUES {names}) AS t(name) ORDER BY md5('0-' || name) LIMIT {categoricals}),
coded AS MATERIALIZED (SELECT * FROM ({values}) WHERE name IN (SELECT name FROM chosen)),
slots AS MATERIALIZED (
  SELECT name, v, {len(dense)} + row_number() OVER (ORDER BY name, v) AS pos
  FROM (SELECT DISTINCT name, v FROM coded WHERE part >= 0)
),
cells AS MATERIALIZED (
  SELECT rid, part, 0 AS pos, 1.0::DOUBLE AS x FROM ranked
  UNION ALL {dense_cells}
  UNION ALL SELECT rid, part, {label}, y FROM ranked
  UNION ALL SELECT rid, part, pos, 1.0::DOUBLE FROM coded JOIN slots USING (name, v)
),
positions AS (SELECT DISTINCT pos FROM cells),
products AS MATERIALIZED (
  SELECT a.part, a.pos AS i, b.pos AS j, sum(a.x * b.x) AS v
  FROM cells a JOIN cells b ON a.rid = b.rid GROUP BY ALL
),
full_products AS MATERIALIZED (
  SELECT p.part, a.pos AS i, b.pos AS j, coalesce(products.v, 0.0) AS v
  FROM (SELECT DISTINCT part FROM cells) p CROSS JOIN positions a CROSS JOIN positions b
  LEFT JOIN products ON products.part = p.part AND products.i = a.pos AND products.j = b.pos
),
-- sets: -1 the test rows, 0..4 all training rows but a fold, 5 all training rows, 10..14 a fold
sets AS (
  SELECT part AS id, part FROM (VALUES (-1)) t(part)
  UNION ALL SELECT k, p FROM range(5) a(k), range(5) b(p) WHERE k <> p
  UNION ALL SELECT 5, p FROM range(5) b(p)
  UNION ALL SELECT 10 + p, p FROM range(5) b(p)
),
sums AS MATERIALIZED (
  SELECT id, i, j, sum(v) AS v FROM sets JOIN full_products USING (part) GROUP BY ALL
),
counts AS (SELECT id, v AS n FROM sums WHERE i = 0 AND j = 0),
averages AS MATERIALIZED (SELECT id, j AS i, v / n AS mean, n FROM sums JOIN counts USING (id) WHERE sums.i = 0),
centred AS MATERIALIZED (
  SELECT s.id, s.i, s.j, s.v - a.mean * b.mean * a.n AS s
  FROM sums s JOIN averages a ON a.id = s.id AND a.i = s.i JOIN averages b ON b.id = s.id AND b.i = s.j
  WHERE s.i > 0 AND s.j > 0
),
scale AS MATERIALIZED (
  SELECT i, sqrt(s / (n - 1)) AS d FROM centred JOIN counts USING (id) WHERE id = 5 AND i = j AND i < {label}
),
-- Spark ML's penalty of the same number is n / (deviation of the label) times as strong
grid AS (SELECT CAST(alpha AS DOUBLE) AS alpha FROM (VALUES {grid}) t(alpha)),
fits AS (
  SELECT k AS id, alpha, alpha AS penalty, 'ridge' AS model FROM range(6) t(k), grid
  UNION ALL
  SELECT 5, alpha, alpha * n / sqrt(s / n), 'mllib' FROM grid, counts, centred
  WHERE counts.id = 5 AND centred.id = 5 AND i = {label} AND j = {label}
),
{basis},
spread AS MATERIALIZED (
  SELECT c.id, a.comp AS i, b.comp AS j, sum(a.w * b.w * c.s) AS s
  FROM centred c JOIN basis a ON a.i = c.i JOIN basis b ON b.i = c.j GROUP BY ALL
  UNION ALL
  SELECT c.id, a.comp, {label}, sum(a.w * c.s) FROM centred c JOIN basis a ON a.i = c.i
  WHERE c.j = {label} GROUP BY ALL
),
system_rows AS (
  SELECT f.id, alpha, model, c.i,
         list(c.s + CASE WHEN c.i = c.j THEN penalty ELSE 0 END ORDER BY c.j) AS row
  FROM fits f JOIN spread c ON c.id = f.id GROUP BY f.id, alpha, model, c.i
),
sys AS (
  SELECT {{'set': id, 'alpha': alpha, 'model': model}} AS id, list(row ORDER BY i) AS m
  FROM system_rows GROUP BY id, alpha, model
),
{sql.ELIMINATION},
slopes AS MATERIALIZED (
  SELECT solved.id.set AS id, solved.id.alpha AS alpha, solved.id.model AS model, i, sum(beta * w) AS b
  FROM solved JOIN (SELECT comp, row_number() OVER (ORDER BY comp) AS pos
                    FROM (SELECT DISTINCT comp FROM basis)) USING (pos)
  JOIN basis USING (comp) GROUP BY ALL
),
-- (training set, set scored): a fold's complement on the fold, all training rows on the test rows
scored AS (
  SELECT k AS id, 10 + k AS other FROM range(5) t(k) UNION ALL SELECT 5, -1
),
biases AS (
  SELECT s.id, s.other, w.alpha, w.model,
         any_value(yo.mean) - any_value(yt.mean) - sum(w.b * (xo.mean - xt.mean)) AS bias
  FROM scored s JOIN slopes w ON w.id = s.id
  JOIN averages xo ON xo.id = s.other AND xo.i = w.i JOIN averages xt ON xt.id = s.id AND xt.i = w.i
  JOIN averages yo ON yo.id = s.other AND yo.i = {label} JOIN averages yt ON yt.id = s.id AND yt.i = {label}
  GROUP BY ALL
),
weights AS MATERIALIZED (
  SELECT id, alpha, model, i, -b AS w FROM slopes
  UNION ALL SELECT DISTINCT id, alpha, model, {label}, 1.0 FROM slopes
),
residuals AS (
  SELECT s.id, s.other, a.alpha, a.model, sum(a.w * b.w * c.s) AS rss
  FROM scored s JOIN weights a ON a.id = s.id
  JOIN weights b ON b.id = s.id AND b.alpha = a.alpha AND b.model = a.model
  JOIN centred c ON c.id = s.other AND c.i = a.i AND c.j = b.i GROUP BY ALL
),
scores AS MATERIALIZED (
  SELECT r.id, r.alpha, r.model, 1 - (rss + counts.n * bias * bias) / c.s AS r2
  FROM residuals r JOIN biases USING (id, other, alpha, model)
  JOIN counts ON counts.id = r.other JOIN centred c ON c.id = r.other AND c.i = {label} AND c.j = {label}
),
means AS (SELECT alpha, avg(r2) AS mean_r2 FROM scores WHERE id < 5 GROUP BY alpha),
best AS (SELECT alpha FROM means ORDER BY mean_r2 DESC, alpha LIMIT 1)
{result}"""


def _run(spark, sf_dir, name):
    preset = replace(PRESETS[name], **FEWER.get(name, {}))
    result = run_experiment(model_rows(spark, sf_dir), SPEC, preset)
    return result.frame(spark).withColumn("r2", F.round("r2", 9))


@query(_experiment_sql(0))
def experiment1(spark, sf_dir):
    """Numericals and ordinals."""
    return _run(spark, sf_dir, "experiment1")


@query(_experiment_sql(1))
def experiment2(spark, sf_dir):
    """With a sixth of the categoricals, drawn at random."""
    return _run(spark, sf_dir, "experiment2")


@query(_experiment_sql(4))
def experiment3(spark, sf_dir):
    """With two thirds of the categoricals, drawn at random."""
    return _run(spark, sf_dir, "experiment3")


@query(_experiment_sql(6, components=10))
def experiment4(spark, sf_dir):
    """With all categoricals, on the leading principal components."""
    return _run(spark, sf_dir, "experiment4")


@query(_experiment_sql(6, (1.0,)))
def experiment5(spark, sf_dir):
    """With all categoricals, at a fixed penalty."""
    return _run(spark, sf_dir, "experiment5")


@query(_experiment_sql(0, by_order=True))
def experiment_many_labels(spark, sf_dir):
    """With the order's key as an ordinal, whose labels the driver may not hold."""
    spec = replace(SPEC, ordinals=(*SPEC.ordinals, "l_orderkey"))
    result = run_experiment(model_rows(spark, sf_dir), spec, PRESETS["experiment1"], max_labels=1000)
    return result.frame(spark).withColumn("r2", F.round("r2", 9))


@query(_experiment_sql(6, (1.0,), predictions=True))
def predict_experiment5(spark, sf_dir):
    """The final model of an experiment on the raw columns of the test rows."""
    rows = model_rows(spark, sf_dir)
    result = run_experiment(rows, SPEC, PRESETS["experiment5"], compare=False)
    test = rows.filter(split_index(SPEC.keys, [0.7, 0.3], 0) != 0)
    scored = result.predict(fill_nulls(drop_null_label(test, SPEC.label), SPEC.numericals))
    return scored.select(*LINE_KEYS, F.round("prediction", 3).alias("prediction"))


@query(f"""WITH {sql.LINES}, train AS (SELECT * FROM lines WHERE is_train),
test AS (SELECT * FROM lines WHERE NOT is_train),
fit AS ({sql.two_feature_fit('train', '0.1')}),
scored AS (SELECT y, b0 + b1 * l_extendedprice + b2 * l_discount AS prediction FROM test, fit)
SELECT 'load' AS step, 'orders' AS metric, CAST(count(*) AS DOUBLE) AS value FROM orders
UNION ALL SELECT 'score', 'rows', CAST(count(*) AS DOUBLE) FROM scored
UNION ALL SELECT 'score', 'r2', round(1 - sum((y - prediction) ** 2) / (count(*) * var_pop(y)), 8) FROM scored
UNION ALL SELECT 'score', 'rmse', {sql.significant('sqrt(avg((y - prediction) ** 2))', 7)} FROM scored""")
def metrics_table(spark, sf_dir):
    """A run logs its numbers to a table, which is then read."""
    log = MetricsLog(spark, new_folder(spark, "metrics"))
    log.add("load", "orders", table(spark, sf_dir, "orders").count())
    log.flush()
    rows = lines(spark, sf_dir).select(*LINE_KEYS, "y", "l_extendedprice", "l_discount")
    train, test = random_split(rows, LINE_KEYS, [0.7, 0.3])
    scored = fit_ridge(train, ["l_extendedprice", "l_discount"], "y", 0.1).predict(test)
    found = regression_metrics(scored, "y", "prediction").first()
    log.add("score", "rows", found["n"])
    log.add("score", "r2", round(found["r2"], 8))
    log.add("score", "rmse", float(f"{found['rmse']:.7g}"))
    log.flush()
    return log.read().select("step", "metric", "value")
