"""The given tables as a modelling table: order lines with their order, part and customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.operators.columns import FeatureSpec
from ridgeway.operators.joins import join_tables
from ridgeway.sources.tables import read_parts, spread

LINE_KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")

SPEC = FeatureSpec(
    label="y",
    numericals=("l_quantity", "l_extendedprice", "l_tax", "p_size", "p_retailprice"),
    ordinals=("l_linenumber", "o_orderpriority"),
    categoricals=(
        "l_returnflag",
        "l_linestatus",
        "p_brand",
        "p_type",
        "c_mktsegment",
        "o_orderstatus",
    ),
    skipping=("o_totalprice",),
    keys=LINE_KEYS,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parts(spark, [f"{sf_dir}/{name}.parquet"], fmt="parquet")


def net_price() -> Column:
    return (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("y")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the label."""
    rows = spread(table(spark, sf_dir, "lineitem"), LINE_KEYS)
    return rows.select("*", net_price())


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the columns of their order, part and customer.

    Orders meet their customers first, so that the lines, by far the largest
    table, are shuffled twice and not three times. Spark takes the size of that
    join to be the product of both sides and would rather broadcast the lines
    where they fall below its threshold; lines and orders grow together and are
    merged.
    """
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    part = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    orders = join_tables(orders, customer, ["o_custkey"])
    rows = table(spark, sf_dir, "lineitem").select("*", net_price())
    rows = join_tables(rows, orders, ["l_orderkey"], strategy="merge")
    return join_tables(rows, part, ["l_partkey"])


def significant(value: str | Column, digits: int = 9) -> Column:
    """Rounded to a number of significant digits: sums depend on the order of addition."""
    v = F.col(value) if isinstance(value, str) else value
    shift = F.lit(digits - 1) - F.floor(F.log10(F.abs(v)))
    up, down = F.pow(F.lit(10.0), shift), F.pow(F.lit(10.0), -shift)
    rounded = F.when(shift >= 0, F.round(v * up) / up).otherwise(F.round(v / down) * down)
    return F.when(v == 0, F.lit(0.0)).otherwise(rounded)
