"""Gram matrix, cross products, vector sums, covariance."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ridgeway.operators import moments as ops
from ridgeway.operators.encode import assemble, fit_labels
from ridgeway.operators.pca import fit_pca
from ridgeway.operators.ridge import with_intercept
from ridgeway.operators.split import with_fold
from ridgeway.queries import sql
from ridgeway.queries.registry import query
from ridgeway.queries.tables import LINE_KEYS, SPEC, lines, model_rows, net_price, significant, table

EMBEDDING_WIDTH = 64


def _products(names: list[str]) -> str:
    """All (i, j, value) with i ≤ j over the given expressions, as one SELECT per entry."""
    return " UNION ALL ".join(
        f"SELECT {i} AS i, {j} AS j, sum(CAST({a} AS DOUBLE) * {b}) AS value, {{group}} FROM {{source}}"
        for j, b in enumerate(names)
        for i, a in enumerate(names[: j + 1])
    )


def _gram_sql(names: list[str], source: str, group: str | None = None) -> str:
    entries = _products(names).format(group=f"{group}" if group else "0 AS no_group", source=source)
    if group:
        entries = entries.replace(f"FROM {source}", f"FROM {source} GROUP BY {group}")
    keep = f"{group}, " if group else ""
    return f"SELECT {keep}i, j, {sql.significant('value')} AS value FROM ({entries})"


@query(f"WITH {sql.MODEL} " + _gram_sql(["1.0", *sql.NUMERICALS], "model"))
def gram_matrix(spark, sf_dir):
    """XᵀX of the numeric columns, intercept in row 0, in index order."""
    design = ops.Design(numericals=SPEC.numericals)
    entries = ops.moments(model_rows(spark, sf_dir), design, centred=False).entries()
    return entries.select("i", "j", significant("value").alias("value")).orderBy("i", "j")


@query(f"WITH {sql.LINES} " + _gram_sql(["1.0", "l_extendedprice", "l_discount", "y"], "lines", "fold"))
def gram_by_fold(spark, sf_dir):
    """All sums that ridge needs, per fold, in one aggregation."""
    rows = with_fold(lines(spark, sf_dir), LINE_KEYS, 5)
    design = ops.Design(numericals=("l_extendedprice", "l_discount"))
    entries = ops.moments(rows, design, "y", by=["fold"], centred=False).entries()
    return entries.select("fold", "i", "j", significant("value").alias("value"))


@query("""
WITH cells AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos
  FROM embeddings
  UNION ALL SELECT vec_id, label, 1.0, 0 FROM embeddings
)
SELECT a.label, CAST(a.pos AS INTEGER) AS i, CAST(b.pos AS INTEGER) AS j,
       round(sum(a.x * b.x), 9) AS value
FROM cells a JOIN cells b ON a.vec_id = b.vec_id AND a.pos <= b.pos GROUP BY ALL""")
def gram_embeddings(spark, sf_dir):
    """XᵀX of a 64-wide vector column per label, by numpy partial sums."""
    design = ops.Design(arrays=(("embedding", EMBEDDING_WIDTH),))
    rows = table(spark, sf_dir, "embeddings").filter("embedding IS NOT NULL")
    entries = ops.moments(rows, design, by=["label"], centred=False).entries()
    return entries.select("label", "i", "j", F.round("value", 9).alias("value"))


_ONE_HOT_SQL = f"""WITH {sql.MODEL},
rows AS (SELECT *, row_number() OVER () AS rid FROM model),
cells AS (
  SELECT rid, 'p_type=' || p_type AS term, 1.0 AS x FROM rows
  UNION ALL SELECT rid, 'c_mktsegment=' || c_mktsegment, 1.0 FROM rows
  UNION ALL SELECT rid, 'l_quantity', l_quantity FROM rows
  UNION ALL SELECT rid, '(intercept)', 1.0 FROM rows
  UNION ALL SELECT rid, 'y', y FROM rows
)
SELECT a.term AS term_a, b.term AS term_b, {sql.significant('sum(a.x * b.x)')} AS value
FROM cells a JOIN cells b ON a.rid = b.rid AND a.term <= b.term GROUP BY ALL"""


@query(_ONE_HOT_SQL)
def gram_one_hot(spark, sf_dir):
    """XᵀX and Xᵀy with one-hot columns that are never made dense, without empty cells."""
    columns = ("p_type", "c_mktsegment")
    rows = model_rows(spark, sf_dir)
    design = ops.Design(
        numericals=("l_quantity",), categoricals=columns, labels=fit_labels(rows, columns)
    )
    table = ops.moments(rows, design, "y", centred=False)
    entries = table.named(table.entries().filter("value <> 0"))
    ordered = [f("term_i", "term_j") for f in (F.least, F.greatest)]
    return entries.select(ordered[0].alias("term_a"), ordered[1].alias("term_b"), significant("value").alias("value"))


_XTY_TERMS = ["1.0", *sql.NUMERICALS, "y"]


@query(f"WITH {sql.MODEL} SELECT position, {sql.significant('value')} AS value FROM (" + " UNION ALL ".join(
    f"SELECT {i} AS position, sum({t} * y) AS value FROM model" for i, t in enumerate(_XTY_TERMS)
) + ")")
def xty_vector(spark, sf_dir):
    """Σy, Xᵀy and yᵀy: the last column of the moments."""
    design = ops.Design(numericals=SPEC.numericals)
    entries = ops.moments(model_rows(spark, sf_dir), design, "y", centred=False).entries()
    last = entries.filter(F.col("j") == len(SPEC.numericals) + 1)
    return last.select(F.col("i").alias("position"), significant("value").alias("value"))


@query("""
SELECT CAST(pos - 1 AS INTEGER) AS position, round(sum(x), 9) AS total FROM (
  SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
GROUP BY pos""")
def vector_sum(spark, sf_dir):
    totals = ops.vector_sum(table(spark, sf_dir, "embeddings"), "embedding")
    return totals.select("position", F.round("total", 9).alias("total"))


_COVARIANCE = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, covar_samp({a}, {b}) AS value FROM model"
    for j, b in enumerate(sql.NUMERICALS)
    for a in sql.NUMERICALS[: j + 1]
)


@query(f"WITH {sql.MODEL} SELECT a, b, {sql.significant('value', 7)} AS value FROM ({_COVARIANCE})")
def covariance_matrix(spark, sf_dir):
    design = ops.Design(numericals=SPEC.numericals)
    table = ops.moments(model_rows(spark, sf_dir), design)
    entries = table.named(table.entries())
    value = significant(F.col("value") / (F.col("n") - 1), 7)
    return entries.select(F.col("term_i").alias("a"), F.col("term_j").alias("b"), value.alias("value"))


_OVER_JOIN = ["l_quantity", "o_totalprice", "l_extendedprice", "y"]
_OVER_JOIN_SQL = " UNION ALL ".join(
    f"SELECT o_orderstatus, '{a}' AS a, '{b}' AS b, count(*) AS n, covar_samp({a}, {b}) AS value FROM met GROUP BY o_orderstatus"
    for j, b in enumerate(_OVER_JOIN)
    for a in _OVER_JOIN[: j + 1]
)


@query(f"""WITH {sql.LINES}, met AS (SELECT * FROM lines JOIN orders ON l_orderkey = o_orderkey)
SELECT o_orderstatus, a, b, n, {sql.significant('value', 7)} AS value FROM ({_OVER_JOIN_SQL})""")
def gram_over_join(spark, sf_dir):
    """Covariances of lines and their orders; one row per order meets the order, not its lines."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    # no spreading: the lines are shuffled by their order anyway
    rows = table(spark, sf_dir, "lineitem").select("*", net_price())
    found = ops.moments_over_join(
        rows, orders, ["l_orderkey"], _OVER_JOIN[:-1], "y", by=["o_orderstatus"]
    )
    entries = found.named(found.entries())
    value = significant(F.col("value") / (F.col("n") - 1), 7)
    names = [F.col("term_i").alias("a"), F.col("term_j").alias("b")]
    return entries.select("o_orderstatus", *names, F.col("n").cast("long").alias("n"), value.alias("value"))


@query("""
SELECT label, count(*) AS n, max(len(embedding)) AS width, max(len(embedding)) + 1 AS with_intercept
FROM embeddings GROUP BY label""")
def row_width_count(spark, sf_dir):
    """Rows per label, and the width of the vector column without and with intercept."""
    found = ops.row_widths(table(spark, sf_dir, "embeddings"), "embedding", ["label"])
    return found.select("label", "n", "width", (F.col("width") + 1).alias("with_intercept"))


@query(f"""WITH {sql.MODEL}
SELECT {sql.KEYS}, l_quantity AS v0, l_extendedprice AS v1, CAST(p_size AS DOUBLE) AS v2,
       CASE WHEN l_linenumber = 2 THEN CAST('NaN' AS DOUBLE) ELSE p_retailprice END AS v3 FROM model""")
def assemble_vector(spark, sf_dir):
    """One vector per row; a null becomes NaN."""
    price = F.when(F.col("l_linenumber") != 2, F.col("p_retailprice"))
    rows = model_rows(spark, sf_dir).withColumn("price", price)
    parts = ["l_quantity", "l_extendedprice", "p_size", "price"]
    values = vector_to_array(F.col("features"))
    return assemble(rows, parts, "features").select(
        *LINE_KEYS, *(values[i].alias(f"v{i}") for i in range(len(parts)))
    )


@query("""
SELECT vec_id, CAST(pos AS INTEGER) AS position, x AS value FROM (
  SELECT vec_id, unnest(list_prepend(1.0::DOUBLE, embedding::DOUBLE[])) AS x,
         generate_subscripts(list_prepend(1.0::DOUBLE, embedding::DOUBLE[]), 1) - 1 AS pos
  FROM embeddings)""")
def add_intercept(spark, sf_dir):
    """1.0 in front of a vector, in long form; the source column stays as it was."""
    values = with_intercept(F.col("embedding").cast("array<double>"))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.posexplode(values).alias("position", "value")
    )


# closed form for two columns: eigenvalues of [[a, c], [c, b]]
_PCA = """pairs AS (
  SELECT var_samp(l_extendedprice) AS a, var_samp(y) AS b, covar_samp(l_extendedprice, y) AS c FROM lines
),
axes AS (
  SELECT *, (a + b + sqrt((a - b) ** 2 + 4 * c * c)) / 2 AS v1,
         (a + b - sqrt((a - b) ** 2 + 4 * c * c)) / 2 AS v2 FROM pairs
),
long_axis AS (
  SELECT *, c / sqrt(c * c + (v1 - a) ** 2) AS u, (v1 - a) / sqrt(c * c + (v1 - a) ** 2) AS w FROM axes
),
signed AS (
  SELECT v1, v2,
         CASE WHEN greatest(abs(u), abs(w)) = abs(u) AND u < 0 OR abs(w) > abs(u) AND w < 0
              THEN -u ELSE u END AS u,
         CASE WHEN greatest(abs(u), abs(w)) = abs(u) AND u < 0 OR abs(w) > abs(u) AND w < 0
              THEN -w ELSE w END AS w
  FROM long_axis
)"""


@query(f"""WITH {sql.LINES}, {_PCA}
SELECT {sql.KEYS}, round(u * l_extendedprice + w * y, 2) AS pc1,
       round(CASE WHEN abs(u) >= abs(w) THEN -w ELSE w END * l_extendedprice
             + CASE WHEN abs(u) >= abs(w) THEN u ELSE -u END * y, 2) AS pc2
FROM lines, signed""")
def pca_2d(spark, sf_dir):
    """Rows projected on both axes; not centred; largest loading positive."""
    rows = lines(spark, sf_dir)
    axes = fit_pca(rows, 2, numericals=["l_extendedprice", "y"])
    return axes.transform(rows).select(
        *LINE_KEYS, F.round("pc1", 2).alias("pc1"), F.round("pc2", 2).alias("pc2")
    )


@query(f"""WITH {sql.LINES}, {_PCA}
SELECT 1 AS component, {sql.significant('v1', 7)} AS variance, round(v1 / (v1 + v2), 9) AS ratio FROM signed
UNION ALL
SELECT 2, {sql.significant('v2', 7)}, round(v2 / (v1 + v2), 9) FROM signed""")
def pca_explained_variance(spark, sf_dir):
    axes = fit_pca(lines(spark, sf_dir), 2, numericals=["l_extendedprice", "y"])
    return axes.explained_variance(spark).select(
        "component", significant("variance", 7).alias("variance"), F.round("ratio", 9).alias("ratio")
    )


_EMBEDDING_AXES = f"""cells AS MATERIALIZED (
  SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings
),
matrix_rows AS (
  SELECT i, list(c ORDER BY j) AS row FROM (
    SELECT a.pos AS i, b.pos AS j, covar_samp(a.x, b.x) AS c
    FROM cells a JOIN cells b ON a.vec_id = b.vec_id GROUP BY ALL) GROUP BY i
),
matrix AS (SELECT list(row ORDER BY i) AS m FROM matrix_rows),
{sql.principal_axes('matrix', 8)},
signed AS (
  SELECT comp, list_transform(v, lambda x: x * CASE
    WHEN list_extract(list_sort(list_transform(v, lambda y: {{'size': abs(y), 'y': y}}), 'DESC'), 1).y < 0
    THEN -1 ELSE 1 END) AS v FROM axes
)"""


@query(f"""WITH RECURSIVE {_EMBEDDING_AXES}
SELECT vec_id, {", ".join(
    f"round(max(CASE WHEN comp = {k} THEN list_dot_product(embedding::DOUBLE[], v) END), 6) AS pc{k}"
    for k in range(1, 9))}
FROM embeddings, signed GROUP BY vec_id""")
def pca_embeddings(spark, sf_dir):
    """Scores of the 64-wide vectors on eight components."""
    rows = table(spark, sf_dir, "embeddings")
    axes = fit_pca(rows, 8, arrays=[("embedding", EMBEDDING_WIDTH)])
    scores = [f"pc{i + 1}" for i in range(axes.k)]
    return axes.transform(rows).select("vec_id", *(F.round(c, 6).alias(c) for c in scores))


# forty combinations of four columns, so that the covariance has four axes
_COMBINED = [
    f"l_quantity / 50 * {(7 * i) % 11 - 5} + l_extendedprice / 1e5 * {(5 * i) % 7 - 3}"
    f" + l_tax * 10 * {(3 * i) % 13 - 6} + l_discount * 10 * {(11 * i) % 5 - 2}"
    for i in range(40)
]


@query(f"""WITH RECURSIVE {sql.LINES},
wide AS (SELECT {", ".join(f"{c} AS x{i}" for i, c in enumerate(_COMBINED))} FROM lines),
matrix AS (SELECT [{", ".join(
    "[" + ", ".join(f"covar_samp(x{i}, x{j})" for j in range(40)) + "]" for i in range(40))}] AS m FROM wide),
{sql.principal_axes('matrix', 4)}
SELECT CAST(comp AS INTEGER) AS component, {sql.significant('variance', 7)} AS variance FROM axes""")
def pca_sketch(spark, sf_dir):
    """Four components of forty columns from two passes that form no matrix."""
    features = F.array(*(F.expr(c.replace("1e5", "1e5D")) for c in _COMBINED))
    found = fit_pca(lines(spark, sf_dir).select(features.alias("v")), 4, arrays=[("v", 40)], method="sketch")
    return found.explained_variance(spark).select("component", significant("variance", 7).alias("variance"))
