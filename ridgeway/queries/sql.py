"""Pieces of the SQL twins. They share no code with the Spark side on purpose."""

from __future__ import annotations

KEYS = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
DIGEST = "md5(concat_ws('-', '0', l_orderkey, l_partkey, l_suppkey, l_linenumber))"
SPLIT = f"('0x' || substr({DIGEST}, 1, 8))::BIGINT"
FOLD = f"('0x' || substr({DIGEST}, 9, 8))::BIGINT % 5"
# 0.7 of the 32-bit range
TRAIN_BOUND = 3006477107

NUMERICALS = ["l_quantity", "l_extendedprice", "l_tax", "p_size", "p_retailprice"]
ORDINALS = ["l_linenumber", "o_orderpriority"]
CATEGORICALS = [
    "l_returnflag",
    "l_linestatus",
    "p_brand",
    "p_type",
    "c_mktsegment",
    "o_orderstatus",
]

# order lines with label, split and fold
LINES = f"""
lines AS (
  SELECT *, l_extendedprice * (1 - l_discount) AS y,
         {SPLIT} < {TRAIN_BOUND} AS is_train, CAST({FOLD} AS INTEGER) AS fold
  FROM lineitem
)"""

# order lines with everything the models use
MODEL = f"""{LINES},
model AS (
  SELECT lines.*, orders.*, part.*, customer.*
  FROM lines
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
)"""


def significant(value: str, digits: int = 9) -> str:
    shift = f"({digits - 1} - floor(log10(abs({value}))))"
    return (
        f"CASE WHEN {value} = 0 THEN 0.0 WHEN {shift} >= 0 "
        f"THEN round({value} * pow(10.0, {shift})) / pow(10.0, {shift}) "
        f"ELSE round({value} / pow(10.0, -{shift})) * pow(10.0, -{shift}) END"
    )


def ranked_labels(source: str, column: str) -> str:
    """(v, r): labels by falling frequency, ties by the smaller string."""
    return (
        f"SELECT CAST({column} AS VARCHAR) AS v, "
        f"CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({column} AS VARCHAR)) - 1 AS DOUBLE) AS r "
        f"FROM {source} WHERE {column} IS NOT NULL GROUP BY CAST({column} AS VARCHAR)"
    )


# Gauss-Jordan elimination of the systems in sys(id, m), m = [A | b] as a list of rows
ELIMINATION = """
elim AS (
  SELECT id, 1 AS k, m FROM sys
  UNION ALL
  SELECT id, k + 1, list_transform(m, lambda row, r: CASE
      WHEN r = k THEN list_transform(row, lambda x: x / row[k])
      ELSE list_transform(row, lambda x, c: x - row[k] * m[k][c] / m[k][k]) END)
  FROM elim WHERE k <= len(m)
),
solved AS (
  SELECT id, unnest(list_transform(m, lambda row: row[len(row)])) AS beta,
         generate_subscripts(m, 1) AS pos
  FROM elim WHERE k = len(m) + 1
)"""


def two_feature_fit(source: str, alpha: str, group: str = "", x1="l_extendedprice", x2="l_discount") -> str:
    """b0, b1, b2 of ridge on two features by Cramer's rule."""
    keys = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    return f"""
    SELECT {keys}my - b1 * m1 - b2 * m2 AS b0, b1, b2 FROM (
      SELECT {keys}my, m1, m2,
             (c1 * (s22 + {alpha}) - c2 * s12) / ((s11 + {alpha}) * (s22 + {alpha}) - s12 * s12) AS b1,
             (c2 * (s11 + {alpha}) - c1 * s12) / ((s11 + {alpha}) * (s22 + {alpha}) - s12 * s12) AS b2
      FROM (
        SELECT {keys}avg(y) AS my, avg({x1}) AS m1, avg({x2}) AS m2,
               count(*) * var_pop({x1}) AS s11, count(*) * var_pop({x2}) AS s22,
               count(*) * covar_pop({x1}, {x2}) AS s12,
               count(*) * covar_pop({x1}, y) AS c1, count(*) * covar_pop({x2}, y) AS c2
        FROM {source} {by}))"""


def principal_axes(matrix: str, k: int, squarings: int = 26) -> str:
    """axes(comp, v, variance): leading axes of the symmetric list of rows in ``matrix``(m).

    A power of the matrix, reached by repeated squaring, shows its leading axis;
    then that axis is taken out and the search starts again.
    """
    last = squarings + 1
    size = "list_sum(list_transform(pow, lambda q: list_dot_product(q, q)))"
    longest = (
        "list_extract(list_sort(list_transform(pow, lambda r: "
        "{'size': list_dot_product(r, r), 'row': r}), 'DESC'), 1)"
    )
    variance = "list_dot_product(v, list_transform(a, lambda q: list_dot_product(q, v)))"
    rest = (
        "list_transform(a, lambda r, i: list_transform(r, lambda x, j: "
        "x - v[i] * v[j] * variance))"
    )
    return f"""
hunt AS (
  SELECT 1 AS comp, 0 AS step, m AS a, m AS pow, m[1] AS v, 0.0::DOUBLE AS variance
  FROM {matrix}
  UNION ALL
  SELECT CASE WHEN step = {last} THEN comp + 1 ELSE comp END,
         CASE WHEN step = {last} THEN 0 ELSE step + 1 END,
         CASE WHEN step = {last} THEN {rest} ELSE a END,
         CASE WHEN step = {last} THEN {rest}
              WHEN step < {squarings} THEN list_transform(pow, lambda r:
                list_transform(pow, lambda c: list_dot_product(r, c) / total)) ELSE pow END,
         CASE WHEN step = {squarings} THEN list_transform(top.row, lambda x: x / sqrt(top.size)) ELSE v END,
         0.0
  FROM (
    SELECT comp, step, a, pow, v, {variance} AS variance,
           CASE WHEN step < {squarings} THEN {size} END AS total,
           CASE WHEN step = {squarings} THEN {longest} END AS top
    FROM hunt WHERE step < {last} OR comp < {k}
  )
),
axes AS (SELECT comp, v, {variance} AS variance FROM hunt WHERE step = {last})"""
