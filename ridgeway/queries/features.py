"""Indexing, one-hot encoding, standardisation, the feature pipeline."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ridgeway.operators.columns import FeatureSpec
from ridgeway.operators.encode import fit_labels, index_with, one_hot, standardize
from ridgeway.operators.encode import string_index as index_strings
from ridgeway.operators.mllib import feature_pipeline as build_pipeline
from ridgeway.operators.split import with_train_flag
from ridgeway.queries import sql
from ridgeway.queries.registry import query
from ridgeway.queries.tables import LINE_KEYS, SPEC, lines, model_rows
from ridgeway.sources.stage import reused


@query(f"""WITH {sql.MODEL}
SELECT {sql.KEYS}, round((l_extendedprice - m1) / d1, 6) AS l_extendedprice_std,
       round((p_size - m2) / d2, 6) AS p_size_std, 0.0::DOUBLE AS constant_std
FROM model, (SELECT avg(l_extendedprice) AS m1, stddev_samp(l_extendedprice) AS d1,
                    avg(p_size) AS m2, stddev_samp(p_size) AS d2 FROM model WHERE is_train)""")
def standardize_numeric(spark, sf_dir):
    """Scaled by the training rows; a column that does not vary becomes 0."""
    rows = with_train_flag(model_rows(spark, sf_dir), LINE_KEYS).withColumn("constant", F.lit(5.1))
    columns = ["l_extendedprice", "p_size", "constant"]
    scaled = standardize(rows, columns, fit_on=rows.filter("is_train"))
    return scaled.select(*LINE_KEYS, *(F.round(f"{c}_std", 6).alias(f"{c}_std") for c in columns))


@query(f"""WITH {sql.MODEL},
ranks AS ({sql.ranked_labels('model', 'o_orderpriority')}),
indexed AS (SELECT {sql.KEYS}, r FROM model JOIN ranks ON o_orderpriority = v)
SELECT {sql.KEYS}, round((r - m) / d, 6) AS o_orderpriority_index_std
FROM indexed, (SELECT avg(r) AS m, stddev_samp(r) AS d FROM indexed)""")
def standardize_ordinal(spark, sf_dir):
    """An ordinal is its frequency rank, then scaled."""
    indexed = index_strings(model_rows(spark, sf_dir), ["o_orderpriority"])
    scaled = standardize(indexed, ["o_orderpriority_index"])
    value = F.round("o_orderpriority_index_std", 6).alias("o_orderpriority_index_std")
    return scaled.select(*LINE_KEYS, value)


@query(f"""WITH {sql.MODEL},
sparse AS (
  SELECT *, CASE WHEN l_linenumber <> 4 THEN p_brand END AS brand,
         CASE WHEN l_linenumber <> 6 THEN l_returnflag END AS flag FROM model
),
brands AS ({sql.ranked_labels('sparse', 'brand')}),
flags AS ({sql.ranked_labels('sparse', 'flag')})
SELECT {sql.KEYS}, coalesce(brands.r, (SELECT count(*) FROM brands)) AS brand_index,
       coalesce(flags.r, (SELECT count(*) FROM flags)) AS flag_index
FROM sparse LEFT JOIN brands ON brand = brands.v LEFT JOIN flags ON flag = flags.v""")
def string_index(spark, sf_dir):
    """Rank by frequency, ties by string; null gets the number of labels."""
    brand = F.when(F.col("l_linenumber") != 4, F.col("p_brand"))
    flag = F.when(F.col("l_linenumber") != 6, F.col("l_returnflag"))
    rows = model_rows(spark, sf_dir).withColumns({"brand": brand, "flag": flag})
    return index_strings(rows, ["brand", "flag"]).select(*LINE_KEYS, "brand_index", "flag_index")


@query(f"""WITH known AS (SELECT * FROM lineitem WHERE l_linenumber NOT IN (2, 6)),
ranks AS ({sql.ranked_labels('known', 'l_linenumber')})
SELECT {sql.KEYS}, coalesce(r, (SELECT count(*) FROM ranks)) AS l_linenumber_index
FROM lineitem LEFT JOIN ranks ON l_linenumber::VARCHAR = v""")
def string_index_unseen(spark, sf_dir):
    """Values that the fitted rows do not hold get the number of labels."""
    rows = lines(spark, sf_dir)
    known = rows.filter(~F.col("l_linenumber").isin(2, 6))
    return index_strings(rows, ["l_linenumber"], fit_on=known).select(*LINE_KEYS, "l_linenumber_index")


@query(f"""WITH ranks AS ({sql.ranked_labels('lineitem', 'l_partkey')})
SELECT {sql.KEYS}, r AS l_partkey_index FROM lineitem JOIN ranks ON l_partkey::VARCHAR = v""")
def string_index_many_labels(spark, sf_dir):
    """A column with more labels than the driver may hold: ranked and joined instead."""
    indexed = index_strings(lines(spark, sf_dir), ["l_partkey"], max_labels=100)
    return indexed.select(*LINE_KEYS, "l_partkey_index")


@query(f"""WITH sparse AS (
  SELECT *, CASE WHEN l_linenumber <> 5 THEN l_returnflag END AS flag FROM lineitem
),
ranks AS ({sql.ranked_labels('sparse', 'flag')})
SELECT {sql.KEYS}, CAST(coalesce(r = 0, false) AS DOUBLE) AS flag_0,
       CAST(coalesce(r = 1, false) AS DOUBLE) AS flag_1, CAST(coalesce(r = 2, false) AS DOUBLE) AS flag_2
FROM sparse LEFT JOIN ranks ON flag = v""", name="one_hot")
def one_hot_flags(spark, sf_dir):
    """Every label has a slot; null is all zeros."""
    flag = F.when(F.col("l_linenumber") != 5, F.col("l_returnflag"))
    rows = lines(spark, sf_dir).withColumn("flag", flag)
    labels = fit_labels(rows, ["flag"])
    encoded = one_hot(index_with(rows, labels), ["flag_index"])
    slots = vector_to_array(F.col("flag_index_onehot"))
    return encoded.select(
        *LINE_KEYS, *(slots[i].alias(f"flag_{i}") for i in range(len(labels["flag"])))
    )


_DENSE = [*sql.NUMERICALS, "line_rank", "priority_rank"]


@query(f"""WITH {sql.MODEL},
train AS (SELECT * FROM model WHERE is_train),
line_ranks AS ({sql.ranked_labels('train', 'l_linenumber')}),
priority_ranks AS ({sql.ranked_labels('train', 'o_orderpriority')}),
indexed AS (
  SELECT model.*, line_ranks.r AS line_rank, priority_ranks.r AS priority_rank
  FROM model JOIN line_ranks ON l_linenumber::VARCHAR = line_ranks.v
  JOIN priority_ranks ON o_orderpriority = priority_ranks.v
),
scale AS (
  SELECT {", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS d{i}" for i, c in enumerate(_DENSE))}
  FROM indexed WHERE is_train
)
SELECT {sql.KEYS}, is_train,
  {", ".join(f"round(({c} - m{i}) / d{i}, 6) AS f{i}" for i, c in enumerate(_DENSE))}
FROM indexed, scale""")
def feature_pipeline(spark, sf_dir):
    """Numericals and ordinals through the Spark ML pipeline, fitted on the training rows."""
    spec = FeatureSpec("y", SPEC.numericals, SPEC.ordinals)
    rows = with_train_flag(model_rows(spark, sf_dir), LINE_KEYS)
    with reused(rows.filter("is_train").select(*spec.features)) as train:
        model = build_pipeline(spec).fit(train)
    values = vector_to_array(F.col("features"))
    width = len(spec.numericals) + len(spec.ordinals)
    return model.transform(rows).select(
        *LINE_KEYS, "is_train", *(F.round(values[i], 6).alias(f"f{i}") for i in range(width))
    )
