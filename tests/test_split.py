from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridgeway.operators import split


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(20000).select("id", (F.col("id") % 7).alias("k2"))


def test_digest_is_plain_md5(spark):
    df = spark.createDataFrame([(5, "a")], "i int, s string")
    digest = df.select(split.key_digest(["i", "s"], seed=2)).first()[0]
    assert digest == hashlib.md5(b"2-5-a").hexdigest()


def test_parts_are_disjoint_and_whole(rows):
    parts = split.random_split(rows, ["id", "k2"], [0.7, 0.3])
    ids = [{r.id for r in p.collect()} for p in parts]
    assert ids[0].isdisjoint(ids[1]) and len(ids[0] | ids[1]) == 20000
    assert abs(len(ids[0]) / 20000 - 0.7) < 0.015


def test_split_does_not_depend_on_the_layout(rows):
    one = split.with_train_flag(rows.coalesce(1), ["id"]).collect()
    two = split.with_train_flag(rows.repartition(5, "k2"), ["id"]).collect()
    assert sorted(one) == sorted(two)
    other = split.with_train_flag(rows, ["id"], seed=1).collect()
    assert sorted(one) != sorted(other)


def test_folds_do_not_depend_on_the_split(rows):
    tagged = split.with_fold(split.with_train_flag(rows, ["id"]), ["id"], 5)
    shares = tagged.groupBy("fold").agg(F.avg(F.col("is_train").cast("int")).alias("s"), F.count("*").alias("n"))
    for r in shares.collect():
        assert abs(r.s - 0.7) < 0.03 and abs(r.n / 20000 - 0.2) < 0.02


def test_complements_are_the_other_folds(rows):
    tagged = split.with_fold(rows, ["id"], 3)
    for i, (train, held_out) in enumerate(split.fold_complements(tagged, 3, max_partitions=2)):
        assert {r.fold for r in held_out.select("fold").distinct().collect()} == {i}
        assert train.count() + held_out.count() == 20000
        assert train.rdd.getNumPartitions() <= 2


def test_shuffle_is_a_permutation(spark):
    shuffled = split.shuffle_rows(spark.range(500), ["id"]).orderBy("position").collect()
    assert [r.position for r in shuffled] == list(range(500))
    ids = [r.id for r in shuffled]
    assert sorted(ids) == list(range(500)) and ids != sorted(ids)


def test_bad_arguments():
    with pytest.raises(ValueError):
        split.split_index(["id"], [0.5, 0.0])
    with pytest.raises(ValueError):
        split.fold_index(["id"], 1)
    with pytest.raises(ValueError):
        split.key_word([], 0)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=4))
def test_any_weights_give_every_row_one_part(spark, weights):
    index = split.split_index(["id"], weights)
    counts = spark.range(300).groupBy(index.alias("part")).count().collect()
    assert sum(r["count"] for r in counts) == 300
    assert all(0 <= r["part"] < len(weights) for r in counts)
