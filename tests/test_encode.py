from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ridgeway.operators import encode
from ridgeway.operators.columns import FeatureSpec
from ridgeway.operators.mllib import feature_pipeline


@pytest.fixture(scope="module")
def letters(spark):
    values = ["b"] * 4 + ["a"] * 4 + ["c"] * 6 + [None] * 2 + ["z"]
    rows = [(i, v, i % 3) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id int, s string, n int").cache()


@pytest.mark.parametrize("order", list(encode.LABEL_ORDERS))
def test_labels_are_ordered_as_by_spark(letters, order):
    theirs = StringIndexer(inputCols=["s", "n"], outputCols=["x", "m"], stringOrderType=order, handleInvalid="keep")
    want = [list(a) for a in theirs.fit(letters).labelsArray]
    found = encode.fit_labels(letters, ["s", "n"], order)
    assert [list(found["s"]), list(found["n"])] == want


@pytest.mark.parametrize("max_labels", [100, 4, 1])
@pytest.mark.parametrize("order", list(encode.LABEL_ORDERS))
def test_index_does_not_depend_on_the_way(letters, max_labels, order):
    """Looked up, looked up in part and joined in part, or joined."""
    known = letters.filter("s IS NULL OR s <> 'z'")
    theirs = StringIndexer(inputCols=["s", "n"], outputCols=["x", "m"], stringOrderType=order, handleInvalid="keep")
    want = {r.id: (r.x, r.m) for r in theirs.fit(known).transform(letters).collect()}
    mine = encode.string_index(letters, ["s", "n"], fit_on=known, order=order, max_labels=max_labels)
    assert {r.id: (r.s_index, r.n_index) for r in mine.collect()} == want
    assert want[16][0] == 3.0 and want[14][0] == 3.0


def test_too_many_labels_is_an_error_not_a_cut(letters):
    with pytest.raises(encode.TooManyLabels):
        encode.fit_labels(letters, ["s"], max_labels=3)


def test_every_label_has_a_slot_and_null_none(letters):
    labels = encode.fit_labels(letters, ["s"])
    encoded = encode.one_hot(encode.index_with(letters, labels), ["s_index"])
    for r in encoded.collect():
        row = r.s_index_onehot.toArray()
        assert len(row) == 4
        assert row.sum() == (0 if r.s is None else 1)
        if r.s is not None:
            assert row[labels["s"].index(r.s)] == 1


def test_standardize_matches_spark(spark):
    rows = [(1.0, 5.1, 1.0), (2.0, 5.1, float("nan")), (4.0, 5.1, 3.0)]
    df = spark.createDataFrame(rows, "a double, constant double, broken double")
    vectors = VectorAssembler(inputCols=df.columns, outputCol="v", handleInvalid="keep").transform(df)
    scaler = StandardScaler(inputCol="v", outputCol="z", withMean=True, withStd=True).fit(vectors)
    want = np.array([r.z.toArray() for r in scaler.transform(vectors).collect()])
    mine = encode.standardize(df, df.columns)
    found = np.array([[r.a_std, r.constant_std, r.broken_std] for r in mine.collect()])
    assert np.allclose(found, want, equal_nan=True)
    assert (found[:, 1] == 0).all() and np.isnan(found[:, 2]).all()


def test_scale_comes_from_the_fitted_rows(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (100.0,)], "a double")
    mine = encode.standardize(df, ["a"], fit_on=df.filter("a < 50"))
    assert mine.orderBy("a").first().a_std == pytest.approx(-1 / 2**0.5)


def test_assembled_nulls_are_nan_or_an_error(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    values = encode.assemble(df, ["a", "b"], "v").select(vector_to_array("v")).first()[0]
    assert values[0] == 1.0 and np.isnan(values[1])
    with pytest.raises(Exception, match="(?i)null"):
        encode.assemble(df, ["a", "b"], "v", invalid="error").collect()


def test_sparse_features_are_the_same_up_to_a_shift(letters):
    rows = letters.withColumn("x", F.col("id") * 1.5)
    spec = FeatureSpec("id", ("x",), ("n",), ("s",))
    dense = feature_pipeline(spec).fit(rows).transform(rows).orderBy("id").collect()
    sparse = feature_pipeline(spec, centre=False).fit(rows).transform(rows).orderBy("id").collect()
    shift = np.array([a.features.toArray() - b.features.toArray() for a, b in zip(dense, sparse)])
    assert np.allclose(shift, shift[0])


@pytest.mark.parametrize("few", [2_000, 3, 0])
def test_columns_are_looked_up_together_or_alone(letters, monkeypatch, few):
    monkeypatch.setattr(encode, "FEW_LABELS", few)
    labels = {"s": ("c", "a"), "n": ("0", "1", "2")}
    found = encode.index_with(letters, labels)
    want = {"c": 0.0, "a": 1.0}
    for r in found.collect():
        assert r.s_index == want.get(r.s, 2.0) and r.n_index == float(r.n)
    assert set(found.columns) == {"id", "s", "n", "s_index", "n_index"}
    assert found.schema["s_index"].metadata["ml_attr"]["vals"] == ["c", "a", "__unknown"]


def test_a_column_without_labels_is_unknown_throughout(letters):
    found = encode.index_with(letters, {"s": (), "n": ("0", "1", "2")})
    assert {r.s_index for r in found.collect()} == {0.0}


@pytest.mark.parametrize("rows, tasks", [(322, 2), (98, 2), (7, 7)])
def test_a_constant_is_standardised_to_zero_in_any_cut(spark, rows, tasks):
    df = spark.range(0, rows, 1, tasks).select(F.lit(5.1).alias("a"), F.lit(None).cast("double").alias("b"), F.col("id").alias("c"))
    found = encode.standardize(df, ["a", "b", "c"]).agg(F.min("a_std"), F.max("a_std"), F.max("b_std"), F.max("c_std")).first()
    assert found[:3] == (0.0, 0.0, 0.0) and found[3] > 1
