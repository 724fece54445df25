"""Shuffling, splitting, folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeway.operators import split
from ridgeway.operators.joins import union_by_name
from ridgeway.queries import sql
from ridgeway.queries.registry import query
from ridgeway.queries.tables import LINE_KEYS, lines, significant


@query(f"""SELECT {sql.KEYS}, row_number() OVER (ORDER BY {sql.DIGEST}, {sql.KEYS}) - 1 AS position
FROM lineitem""")
def shuffle_rows(spark, sf_dir):
    return split.shuffle_rows(lines(spark, sf_dir).select(*LINE_KEYS), LINE_KEYS)


@query(f"WITH {sql.LINES} SELECT {sql.KEYS}, is_train FROM lines")
def split_train_test(spark, sf_dir):
    return split.with_train_flag(lines(spark, sf_dir).select(*LINE_KEYS), LINE_KEYS)


@query(f"""SELECT {sql.KEYS}, CASE WHEN w < 2147483648 THEN 0 WHEN w < 3435973837 THEN 1 ELSE 2 END AS part
FROM (SELECT *, {sql.SPLIT} AS w FROM lineitem)""")
def split_three_ways(spark, sf_dir):
    """Weights 5 : 3 : 2, as three tables whose union is the whole."""
    parts = split.random_split(lines(spark, sf_dir).select(*LINE_KEYS), LINE_KEYS, [5, 3, 2])
    tagged = [p.withColumn("part", F.lit(i)) for i, p in enumerate(parts)]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query(f"WITH {sql.LINES} SELECT {sql.KEYS}, fold FROM lines WHERE is_train")
def assign_folds(spark, sf_dir):
    train = split.random_split(lines(spark, sf_dir).select(*LINE_KEYS), LINE_KEYS, [0.7, 0.3])[0]
    return split.with_fold(train, LINE_KEYS, 5)


@query(f"""WITH {sql.LINES}, held AS (SELECT unnest(range(5)) AS k)
SELECT CAST(k AS INTEGER) AS left_out, fold <> k AS training, {sql.KEYS}, fold, y FROM lines, held""")
def fold_training_union(spark, sf_dir):
    """Training and validation rows of all five held-out folds, on a capped number of partitions."""
    rows = split.with_fold(lines(spark, sf_dir), LINE_KEYS, 5).select(*LINE_KEYS, "fold", "y")
    partitions = max(200, 4 * spark.sparkContext.defaultParallelism)
    halves = [
        half.select(F.lit(i).alias("left_out"), F.lit(training).alias("training"), "*")
        for i, pair in enumerate(split.fold_complements(rows, 5, max_partitions=partitions))
        for training, half in zip((True, False), pair)
    ]
    return union_by_name(*halves)


@query(f"""WITH {sql.LINES}, held AS (SELECT unnest(range(5)) AS k)
SELECT CAST(k AS INTEGER) AS left_out, CAST(count(*) AS BIGINT) AS n,
       {sql.significant('sum(y)')} AS sum_y
FROM held JOIN lines ON fold <> k GROUP BY k""")
def leave_one_fold_out(spark, sf_dir):
    """Size and label total of all five training sets, from one pass."""
    rows = split.with_fold(lines(spark, sf_dir), LINE_KEYS, 5)
    per_fold = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("sum_y"))
    sets = split.leave_one_out(per_fold, 5, ["n", "sum_y"])
    return sets.select("left_out", "n", significant("sum_y").alias("sum_y"))
