"""Labels, indices, standardisation and the feature columns made from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.feature import ElementwiseProduct, OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeway.functions.linear import linear_column, projection
from ridgeway.operators.joins import with_position
from ridgeway.operators.moments import Design
from ridgeway.operators.ridge import LinearFit

# labels that may be held by the driver and sent to every task
MAX_LABELS = 200_000

# labels of a column that is looked up together with others
FEW_LABELS = 2_000

# rank order of labels; ties of frequency go to the smaller string
LABEL_ORDERS: Mapping[str, tuple[str, ...]] = {
    "frequencyDesc": ("-count", "value"),
    "frequencyAsc": ("count", "value"),
    "alphabetDesc": ("-value",),
    "alphabetAsc": ("value",),
}


class TooManyLabels(ValueError):
    """The columns hold more labels than may be collected."""


def label_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, count) of all columns, from one aggregation; nulls left out."""
    strings = df.select(*(F.col(c).cast("string").alias(c) for c in columns))
    return (
        strings.unpivot([], list(columns), "column_name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def fit_labels(
    df: DataFrame,
    columns: Sequence[str],
    order: str = "frequencyDesc",
    max_labels: int = MAX_LABELS,
) -> dict[str, tuple[str, ...]]:
    """The labels of each column in rank order, held by the driver.

    More than ``max_labels`` is an error, never a cut: such a column needs
    :func:`rank_labels`, and one-hot columns of that width no Gram matrix holds.
    """
    if not columns:
        return {}
    found = label_counts(df, columns).limit(max_labels + 1).collect()
    if len(found) > max_labels:
        raise TooManyLabels(f"{list(columns)} hold more than {max_labels} labels")
    grouped: dict[str, list[tuple[int, str]]] = {c: [] for c in columns}
    for row in found:
        grouped[row["column_name"]].append((row["count"], row["value"]))
    return {c: tuple(v for _, v in _ranked(pairs, order)) for c, pairs in grouped.items()}


def _ranked(pairs: list[tuple[int, str]], order: str) -> list[tuple[int, str]]:
    ranked = list(pairs)
    for part in reversed(LABEL_ORDERS[order]):
        at = 0 if part.endswith("count") else 1
        ranked.sort(key=lambda pair: pair[at], reverse=part.startswith("-"))
    return ranked


def rank_labels(df: DataFrame, column: str, order: str = "frequencyDesc") -> DataFrame:
    """(value, rank) for a column with any number of labels; nothing is collected."""
    counts = label_counts(df, [column]).drop("column_name")
    keys = [F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in LABEL_ORDERS[order]]
    ranked = with_position(counts, keys, "rank")
    return ranked.select("value", "rank")


def string_index(
    df: DataFrame,
    columns: Sequence[str],
    fit_on: DataFrame | None = None,
    order: str = "frequencyDesc",
    max_labels: int = MAX_LABELS,
    suffix: str = "_index",
) -> DataFrame:
    """Replace values by the rank of their label in ``fit_on`` (default: ``df``).

    Null and unseen values get the number of labels. Few labels are looked up in
    a table each task holds; more are joined.
    """
    source = df if fit_on is None else fit_on
    try:
        return index_with(df, fit_labels(source, columns, order, max_labels), suffix)
    except TooManyLabels:
        if len(columns) == 1:
            return _index_by_join(df, columns[0], rank_labels(source, columns[0], order), suffix)
    # each column on its own, so that only those with many labels are joined
    for column in columns:
        df = string_index(df, [column], source, order, max_labels, suffix)
    return df


def index_with(
    df: DataFrame, labels: Mapping[str, Sequence[str]], suffix: str = "_index"
) -> DataFrame:
    """Index columns whose labels are known, with Spark's own lookup."""
    few = {c: v for c, v in labels.items() if len(v) <= FEW_LABELS}
    if few:
        df = _index_together(df, few, suffix)
    for column in labels.keys() - few.keys():
        model = StringIndexerModel.from_labels(
            list(labels[column]), inputCol=column, outputCol=column + suffix, handleInvalid="keep"
        )
        df = model.transform(df)
    return df


def _index_together(df: DataFrame, labels: Mapping[str, Sequence[str]], suffix: str) -> DataFrame:
    """One indexer for many columns: a chain of one per column takes long to plan.

    Label lists must reach the JVM at equal length, or it fills them up with
    nulls that count as labels. They are filled here with strings longer than
    any label, and the rank of unknown values is put right afterwards.
    """
    length = max(1, *(len(v) for v in labels.values()))
    mark = "\0" * (1 + max((len(x) for v in labels.values() for x in v), default=0))
    filled = [[*v, *(f"{mark}{i}" for i in range(length - len(v)))] for v in labels.values()]
    model = StringIndexerModel.from_arrays_of_labels(
        filled,
        inputCols=list(labels),
        outputCols=[f"_{c}{suffix}" for c in labels],
        handleInvalid="keep",
    )

    def ranked(column: str, values: Sequence[str]) -> Column:
        rank = F.col(f"_{column}{suffix}")
        rank = F.when(rank == length, F.lit(float(len(values)))).otherwise(rank)
        attribute = {"type": "nominal", "name": column + suffix, "vals": [*values, "__unknown"]}
        return rank.alias(column + suffix, metadata={"ml_attr": attribute})

    found = model.transform(df)
    return found.select("*", *(ranked(c, v) for c, v in labels.items())).drop(
        *(f"_{c}{suffix}" for c in labels)
    )


def index_by_ranks(df: DataFrame, ranks: Mapping[str, DataFrame]) -> DataFrame:
    """Replace columns by the ranks of their labels, from tables (value, rank) of any length.

    Null and unseen values get the number of labels.
    """
    for column, table in ranks.items():
        df = _index_by_join(df, column, table, "")
    return df


def _index_by_join(df: DataFrame, column: str, ranks: DataFrame, suffix: str) -> DataFrame:
    unknown = ranks.count()
    found = ranks.select(
        F.col("value").alias("_value"), F.col("rank").cast("double").alias("_rank")
    )
    # a left join: the adaptive planner may split the partition of a hot value
    joined = df.join(found, F.col(column).cast("string") == F.col("_value"), "left")
    index = F.coalesce("_rank", F.lit(float(unknown)))
    return joined.withColumn(column + suffix, index).drop("_value", "_rank")


def one_hot(df: DataFrame, columns: Sequence[str], suffix: str = "_onehot") -> DataFrame:
    """One vector per indexed column; every label has a slot, the unknown rank has none."""
    encoder = OneHotEncoder(
        inputCols=list(columns), outputCols=[c + suffix for c in columns], dropLast=True
    )
    return encoder.fit(df).transform(df)


def assemble(df: DataFrame, columns: Sequence[str], name: str, invalid: str = "keep") -> DataFrame:
    """One vector from numbers and vectors; with 'keep' a null becomes NaN."""
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid=invalid).transform(df)


def standardize(
    df: DataFrame,
    columns: Sequence[str],
    fit_on: DataFrame | None = None,
    suffix: str = "_std",
) -> DataFrame:
    """(x − mean) / sample deviation; a column that does not vary becomes 0.

    Means, deviations and bounds come from one aggregation over ``fit_on``. The
    bounds tell a constant: its merged deviation need not be exactly 0.
    """
    source = df if fit_on is None else fit_on
    numbers = {c: F.col(c).cast("double") for c in columns}
    stats = source.agg(
        *(F.avg(x).alias(f"{c}_mean") for c, x in numbers.items()),
        *(F.stddev_samp(x).alias(f"{c}_dev") for c, x in numbers.items()),
        *((F.min(x) < F.max(x)).alias(f"{c}_varies") for c, x in numbers.items()),
    ).first()

    def scaled(c: str) -> Column:
        mean, dev = stats[f"{c}_mean"], stats[f"{c}_dev"]
        if not stats[f"{c}_varies"]:
            return F.lit(0.0)
        return (numbers[c] - F.lit(mean)) / F.lit(dev)

    return df.withColumns({c + suffix: scaled(c) for c in columns})


def predict_design(
    df: DataFrame, design: Design, fit: LinearFit, name: str = "prediction"
) -> DataFrame:
    """Score a table that holds the raw columns of a design.

    Labels become ranks by Spark's lookup, ranks become weights by position; no
    vector is built and no Python runs.
    """
    coded = [*design.ordinals, *design.categoricals]
    indexed = index_with(df, {c: design.labels[c] for c in coded}, "_rank")
    slopes = dict(zip(fit.terms, fit.slopes))
    terms = [(F.col(c).cast("double"), slopes[c]) for c in design.numericals]
    terms += [(F.col(f"{c}_rank"), slopes[c]) for c in design.ordinals]
    score = linear_column(fit.intercept, terms)
    for c in design.categoricals:
        weights = [float(slopes[f"{c}={v}"]) for v in design.labels[c]]
        table = F.lit(np.array([*weights, 0.0]))  # one literal, whatever the number of labels
        score = score + F.element_at(table, F.col(f"{c}_rank").cast("int") + 1)
    return indexed.withColumn(name, score).drop(*(f"{c}_rank" for c in coded))


def design_vectors(
    df: DataFrame, design: Design, basis: np.ndarray, keep: Sequence[str], name: str = "features"
) -> DataFrame:
    """``keep`` and one vector per row: the design's features times ``basis``, nothing refitted.

    ``basis`` is a factor per feature, or a matrix whose columns are the new features.
    """
    coded = [*design.ordinals, *design.categoricals]
    rows = index_with(df, {c: design.labels[c] for c in coded}, "_rank")
    parts = [*design.numericals, *(f"{c}_rank" for c in design.ordinals)]
    if design.categoricals:
        slots = [f"{c}_slots" for c in design.categoricals]
        encoder = OneHotEncoder(
            inputCols=[f"{c}_rank" for c in design.categoricals], outputCols=slots, dropLast=True
        )
        rows = encoder.fit(rows).transform(rows)  # widths come from the labels: no job
        parts += slots
    raw = assemble(rows, parts, "_raw")
    if basis.ndim == 1:
        scale = ElementwiseProduct(scalingVec=Vectors.dense(basis), inputCol="_raw", outputCol=name)
        return scale.transform(raw).select(*keep, name)
    scores = projection(basis)(vector_to_array("_raw"))
    return raw.select(*keep, array_to_vector(scores).alias(name))
