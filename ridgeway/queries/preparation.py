"""Scans, column pruning, roles, nulls, joins, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeway.operators.columns import assign_roles, drop_columns, drop_matching, random_subset
from ridgeway.operators.joins import join_checked, join_tables, union_by_name, zip_join
from ridgeway.operators.rows import drop_null_label, fill_nulls, non_null_counts
from ridgeway.queries import sql
from ridgeway.queries.registry import query
from ridgeway.queries.tables import LINE_KEYS, SPEC, lines, model_rows, table
from ridgeway.sources.stage import new_folder
from ridgeway.sources.tables import load_modelling_table, read_mixed, read_parts, write_parts


@query("SELECT * FROM orders")
def scan_parts(spark, sf_dir):
    """Two CSV parts of the orders, read back as one table with a given schema."""
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit("1995-01-01").cast("timestamp_ntz")
    folder = new_folder(spark, "orders-csv")
    paths = [
        write_parts(orders.filter(early), f"{folder}/a", "csv"),
        write_parts(orders.filter(~early), f"{folder}/b", "csv"),
    ]
    return read_parts(spark, paths, orders.schema)


def _mixed(spark, sf_dir):
    """Orders in two CSV parts of another column order, a column too many, and numbers that are none."""
    orders = table(spark, sf_dir, "orders")
    odd = F.col("o_orderkey") % 2 == 1
    price = F.when(F.col("o_orderkey") % 97 == 3, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    date = F.when(F.col("o_orderkey") % 89 == 5, "soon").otherwise(F.col("o_orderdate").cast("string"))
    other = orders.filter(odd).withColumns({"o_totalprice": price, "o_orderdate": date, "note": F.lit("a, b")})
    folder = new_folder(spark, "orders-mixed")
    paths = [
        write_parts(orders.filter(~odd).drop("o_orderstatus"), f"{folder}/a", "csv"),
        write_parts(other.select(*sorted(other.columns, reverse=True)), f"{folder}/b", "csv"),
    ]
    return read_mixed(spark, paths, orders.schema)


_ODD = "o_orderkey % 2 = 1"
_BAD_PRICE, _BAD_DATE = f"({_ODD} AND o_orderkey % 97 = 3)", f"({_ODD} AND o_orderkey % 89 = 5)"


@query(f"""SELECT o_orderkey, o_custkey, CASE WHEN {_ODD} THEN o_orderstatus END AS o_orderstatus, o_totalprice,
       o_orderdate, o_orderpriority FROM orders WHERE NOT {_BAD_PRICE} AND NOT {_BAD_DATE}""")
def scan_parts_mixed(spark, sf_dir):
    """Columns by each file's own header; records that don't parse are elsewhere."""
    return _mixed(spark, sf_dir).rows


@query(f"""SELECT o_orderkey, concat_ws(',', CASE WHEN {_BAD_PRICE} THEN 'o_totalprice' END,
       CASE WHEN {_BAD_DATE} THEN 'o_orderdate' END) AS reason FROM orders WHERE {_BAD_PRICE} OR {_BAD_DATE}""")
def scan_parts_rejected(spark, sf_dir):
    """The records that don't parse, and why."""
    rejected = _mixed(spark, sf_dir).rejected
    return rejected.select(F.get_json_object("record", "$.o_orderkey").cast("long").alias("o_orderkey"), "reason")


@query("""WITH o AS (SELECT * FROM orders WHERE o_orderkey % 10 <> 3 UNION ALL SELECT * FROM orders WHERE o_orderkey % 50 = 7),
copies AS (SELECT o_orderkey, count(*) AS n FROM o GROUP BY o_orderkey)
SELECT (SELECT count(*) FROM lineitem JOIN o ON l_orderkey = o_orderkey) AS n_joined,
  (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM o)) AS n_unmatched,
  (SELECT coalesce(sum(n), 0)::BIGINT FROM lineitem JOIN copies ON l_orderkey = o_orderkey WHERE n > 1) AS n_repeated""")
def join_key_contract(spark, sf_dir):
    """Lines of orders, some missing and some there twice: both counted by the scan that joins."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    twice = orders.filter("l_orderkey % 10 <> 3").unionByName(orders.filter("l_orderkey % 50 = 7"))
    joined, met = join_checked(table(spark, sf_dir, "lineitem"), twice, ["l_orderkey"])
    n = joined.count()
    counts = met.get
    rows = [(n, counts["unmatched"], counts["repeated"])]
    return spark.createDataFrame(rows, "n_joined long, n_unmatched long, n_repeated long")


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
       "l_discount, l_returnflag, l_linestatus FROM lineitem", name="drop_columns")
def drop_columns_by_name(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return drop_columns(rows, ["l_tax", "l_shipdate", "no_such_column"])


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_shipdate FROM lineitem")
def drop_columns_regex(spark, sf_dir):
    """Whole names, any case, with an exception inside the pattern."""
    rows = table(spark, sf_dir, "lineitem")
    return drop_matching(rows, ["(L_EXT|l_disc)+?.+", "l_(tax|return.*)", "(?!l_shipdate)(l_.+)(s|e|t).*us"])


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, o_custkey, o_orderstatus, o_orderpriority
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""", name="load_modelling_table")
def load_modelling(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return load_modelling_table(
        table(spark, sf_dir, "lineitem"),
        orders,
        on=["l_orderkey"],
        drop=["o_totalprice", "l_linestatus", "l_linenumber"],
        drop_after_join=["l_partkey", "l_suppkey"],
        drop_patterns=[".+date"],
        keep=["l_orderkey", "l_linenumber"],
    )


@query(f"""WITH {sql.MODEL}
SELECT y, l_quantity, l_extendedprice, l_tax, p_size, p_retailprice FROM model""")
def final_projection(spark, sf_dir):
    return model_rows(spark, sf_dir).select(SPEC.label, *SPEC.numericals)


def _roles_sql() -> str:
    roles = [("l_orderkey", "key"), ("l_partkey", "key"), ("l_suppkey", "key"), ("l_linenumber", "key")]
    roles += [("y", "label"), ("o_totalprice", "skipping")]
    roles += [(c, "numerical") for c in sql.NUMERICALS] + [(c, "ordinal") for c in sql.ORDINALS]
    roles += [(c, "categorical") for c in sql.CATEGORICALS]
    parts = [
        f"SELECT '{c}' AS column_name, '{r}' AS role, count({c}) AS non_null FROM model" for c, r in roles
    ]
    return f"WITH {sql.MODEL} " + " UNION ALL ".join(parts)


@query(_roles_sql())
def role_assignment(spark, sf_dir):
    """The part each column plays, with its number of values (none: the column is dead)."""
    unused = ("o_custkey", "l_discount", "l_shipdate", "o_orderdate", "p_name")
    rows = model_rows(spark, sf_dir).drop(*unused, "c_name", "c_nationkey", "c_acctbal")
    spec = assign_roles(
        rows.columns, SPEC.label, SPEC.numericals, SPEC.ordinals, SPEC.skipping, SPEC.keys
    )
    roles = spark.createDataFrame(spec.roles(), "column_name string, role string")
    counts = non_null_counts(rows, rows.columns)
    return join_tables(roles, counts, ["column_name"])


@query(f"""WITH {sql.MODEL}, chosen AS (
  SELECT name FROM (VALUES {", ".join(f"('{c}')" for c in sql.CATEGORICALS)}) AS names(name)
  ORDER BY md5('7-' || name) LIMIT 4
)
SELECT {sql.KEYS}, column_name, value
FROM (UNPIVOT (SELECT {sql.KEYS}, {", ".join(sql.CATEGORICALS)} FROM model)
      ON {", ".join(sql.CATEGORICALS)} INTO NAME column_name VALUE value)
WHERE column_name IN (SELECT name FROM chosen)""")
def feature_subset(spark, sf_dir):
    """Four of the categorical columns, drawn by seed."""
    chosen = random_subset(SPEC.categoricals, 4, seed=7)
    return model_rows(spark, sf_dir).unpivot(list(LINE_KEYS), chosen, "column_name", "value")


@query(f"""SELECT {sql.KEYS}, l_extendedprice AS label FROM lineitem WHERE l_linenumber <> 7""", name="drop_null_label")
def drop_unlabelled_rows(spark, sf_dir):
    label = F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice"))
    rows = table(spark, sf_dir, "lineitem").withColumn("label", label)
    return drop_null_label(rows, "label").select(*LINE_KEYS, "label")


@query(f"""SELECT {sql.KEYS}, CASE WHEN l_linenumber = 3 THEN 0.0 ELSE l_quantity END AS l_quantity,
  CASE WHEN l_linenumber = 5 THEN 0.0 ELSE l_tax END AS l_tax FROM lineitem""", name="fill_nulls")
def fill_null_numbers(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        *LINE_KEYS,
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_linenumber") != 5, F.col("l_tax")).alias("l_tax"),
    )
    return fill_nulls(rows, ["l_quantity", "l_tax"])


@query(f"""SELECT {sql.KEYS}, l_extendedprice, o_custkey, o_totalprice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""", name="join_person_housing")
def join_lines_orders(spark, sf_dir):
    """Many lines to one order, as persons to their household."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    joined = join_tables(lines(spark, sf_dir), orders, ["l_orderkey"])
    return joined.select(*LINE_KEYS, "l_extendedprice", "o_custkey", "o_totalprice")


@query("""
SELECT * FROM lineitem JOIN (
  SELECT l_orderkey, l_partkey, l_suppkey, l_quantity AS first_quantity
  FROM lineitem WHERE l_linenumber = 1) USING (l_orderkey, l_partkey, l_suppkey)""")
def join_multi_key(spark, sf_dir):
    """Three key columns, each once in the result: lines next to line 1 of the same goods.

    Both sides are plain scans, so the adaptive planner may split a hot key.
    """
    rows = table(spark, sf_dir, "lineitem")
    first = rows.filter("l_linenumber = 1").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_quantity").alias("first_quantity")
    )
    return join_tables(rows, first, ["l_orderkey", "l_partkey", "l_suppkey"])


@query("""
SELECT position, a.o_orderkey, a.o_custkey, b.other_orderkey, b.o_totalprice
FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS position, o_orderkey, o_custkey FROM orders) a
JOIN (SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS position,
             o_orderkey AS other_orderkey, o_totalprice FROM orders) b USING (position)""", name="zip_join")
def zip_join_orders(spark, sf_dir):
    """The i-th order by key next to the i-th order by price."""
    orders = table(spark, sf_dir, "orders")
    left = orders.select("o_orderkey", "o_custkey")
    right = orders.select(F.col("o_orderkey").alias("other_orderkey"), "o_totalprice")
    return zip_join(left, right, ["o_orderkey"], [F.desc("o_totalprice"), "other_orderkey"])


@query("SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem", name="union_by_name")
def union_parts_by_name(spark, sf_dir):
    """Parts with their columns in different orders."""
    rows = table(spark, sf_dir, "lineitem")
    a = rows.filter("l_returnflag = 'A'").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    n = rows.filter("l_returnflag = 'N'").select("l_quantity", "l_orderkey", "l_returnflag", "l_linenumber")
    rest = rows.filter("l_returnflag NOT IN ('A', 'N')").select(*reversed(a.columns))
    return union_by_name(a, n, rest)
