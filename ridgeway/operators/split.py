"""Shuffling, train/test splits and folds, all decided by a digest of the row key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeway.functions.digest import WORD_BITS, key_digest, key_word
from ridgeway.operators.joins import with_position

# words of the digest, kept apart so that the fold does not depend on the split
SPLIT_WORD, FOLD_WORD = 0, 1


def shuffle_rows(df: DataFrame, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """A reproducible random permutation: rows numbered in digest order."""
    tagged = df.withColumn("_digest", key_digest(keys, seed))
    return with_position(tagged, ["_digest", *keys]).drop("_digest")


def split_index(keys: Sequence[str], weights: Sequence[float], seed: int = 0) -> Column:
    """Index of the part a row falls into; parts have the given relative weights."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    total = float(sum(weights))
    word = key_word(keys, SPLIT_WORD, seed)
    index, upto = F.lit(len(weights) - 1), float(sum(weights[:-1]))
    for part in range(len(weights) - 2, -1, -1):
        bound = round(upto / total * 2**WORD_BITS)
        index = F.when(word < bound, F.lit(part)).otherwise(index)
        upto -= weights[part]
    return index


def with_train_flag(
    df: DataFrame,
    keys: Sequence[str],
    weights: tuple[float, float] = (0.7, 0.3),
    seed: int = 0,
    name: str = "is_train",
) -> DataFrame:
    """Bernoulli train/test split as a boolean column."""
    return df.withColumn(name, split_index(keys, weights, seed) == 0)


def random_split(
    df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int = 0
) -> list[DataFrame]:
    """Disjoint tables that together hold every row once."""
    tagged = df.withColumn("_part", split_index(keys, weights, seed))
    return [tagged.filter(F.col("_part") == i).drop("_part") for i in range(len(weights))]


def fold_index(keys: Sequence[str], k: int, seed: int = 0) -> Column:
    if k < 2:
        raise ValueError("cross-validation needs at least two folds")
    return (key_word(keys, FOLD_WORD, seed) % k).cast("int")


def with_fold(
    df: DataFrame, keys: Sequence[str], k: int = 5, seed: int = 0, name: str = "fold"
) -> DataFrame:
    """K disjoint folds as an integer column."""
    return df.withColumn(name, fold_index(keys, k, seed))


def fold_complements(
    df: DataFrame, k: int, fold: str = "fold", max_partitions: int | None = None
) -> list[tuple[DataFrame, DataFrame]]:
    """(training rows, validation rows) for each held-out fold.

    The union of the other folds is the same bag as one filter, which scans the
    table once instead of once per fold. ``max_partitions`` caps the training
    set's partition count without a shuffle.
    """
    pairs = []
    for i in range(k):
        train = df.filter(F.col(fold) != i)
        if max_partitions is not None:
            train = train.coalesce(max_partitions)
        pairs.append((train, df.filter(F.col(fold) == i)))
    return pairs


def leave_one_out(per_fold: DataFrame, k: int, sums: Sequence[str], fold: str = "fold") -> DataFrame:
    """Totals over all folds but one, from additive totals per fold.

    Rows are never repeated: ``per_fold`` has K rows, and only those are sent to
    the K-1 training sets they belong to.
    """
    others = F.filter(
        F.sequence(F.lit(0), F.lit(k - 1)), lambda i: i != F.col(fold).cast("int")
    )
    sent = per_fold.select(F.explode(others).alias("left_out"), *sums)
    return sent.groupBy("left_out").agg(*(F.sum(c).alias(c) for c in sums))
