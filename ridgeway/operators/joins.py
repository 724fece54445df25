"""Equi-joins and the positional join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ridgeway.sources.stage import staged


def join_tables(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    strategy: str | None = None,
) -> DataFrame:
    """Join on equally named columns, which appear once in the result.

    Without a strategy Spark broadcasts a side only below its checked size
    threshold, and otherwise sorts and merges, where the adaptive planner cuts
    the partitions of a hot key into pieces. ``strategy`` ('merge', …) is passed
    on as a hint where sizes are known to be estimated badly.
    """
    if strategy is not None:
        right = right.hint(strategy)
    return left.join(right, on=list(on), how=how)


def join_checked(left: DataFrame, right: DataFrame, on: Sequence[str], name: str = "join") -> tuple[DataFrame, Observation]:
    """The inner join, and what its scan tells about the contract that ``right`` has each key once.

    The counts come with whatever action reads the join, without a job of their own:
    ``rows`` of the result, ``unmatched`` rows of ``left`` without a partner (null keys
    included), ``repeated`` rows of the result whose key ``right`` has more than once.
    Copies of a key are counted where the join has put them anyway.
    """
    copies, met = "_copies", Observation(name)
    key = Window.partitionBy(*on)
    counted = right.withColumn(copies, F.count(F.lit(1)).over(key))
    matched = F.col(copies).isNotNull()
    # the counts stand between the join and the filter, so unmatched rows are still there
    rows = left.join(counted, list(on), "left").observe(
        met,
        F.count(F.when(matched, 1)).alias("rows"),
        F.count(F.when(~matched, 1)).alias("unmatched"),
        F.count(F.when(F.col(copies) > 1, 1)).alias("repeated"),
    )
    return rows.filter(matched).drop(copies), met


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Bag union of any number of tables, columns matched by name."""
    if not frames:
        raise ValueError("nothing to unite")
    return reduce(DataFrame.unionByName, frames)


def with_position(
    df: DataFrame, order: Sequence[str | Column], name: str = "position"
) -> DataFrame:
    """Number the rows 0, 1, 2, … in the given (total) order.

    A global window would sort everything in one task. Here the rows are
    range-partitioned and sorted, numbered inside their partition, and the
    partition's offset is added from a table with one row per partition. The
    sorted table is staged first: range boundaries come from a sample, and a
    second evaluation must not meet other boundaries.
    """
    mark = f"_{name}_mark"
    marked = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(mark, F.monotonically_increasing_id())
    )
    rows = staged(marked, "positions").withColumn("_part", F.shiftright(mark, 33))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the sorted table, whatever the table's size
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_off"))
    inside = F.col(mark).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        rows.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_off") + inside)
        .drop("_part", "_off", mark)
    )


def zip_join(
    left: DataFrame,
    right: DataFrame,
    left_order: Sequence[str | Column],
    right_order: Sequence[str | Column],
) -> DataFrame:
    """Pair the i-th row of one table with the i-th row of the other."""
    numbered = with_position(right, right_order)
    return with_position(left, left_order).join(numbered, "position")
