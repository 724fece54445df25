from __future__ import annotations

import numpy as np
import pyarrow as pa
from samples import awkward, none_of, prose
from pyspark.sql import functions as F

from ridgeway.llm import quality
from ridgeway.llm.common import held_out

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.quality_scores(docs, labels).join(labels, "doc_id").where("held_out")
    right, n = found.agg(F.sum((F.col("quality") == F.col("predicted")).cast("int")), F.count("*")).first()
    assert n > 800 and right / n > 0.99


def test_labels_of_held_out_documents_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in quality.quality_scores(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_additive_model_learns_steps_and_pairs():
    r = np.random.default_rng(3)
    x = r.uniform(size=(4000, 3))
    y = (((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)) | (x[:, 2] > 0.9)).astype(float)
    model = quality.AdditiveModel.fit(x, y)
    assert (0, 1) in model.pairs and ((model.score(x) > 0.5) == (y > 0)).mean() > 0.9
    assert quality.AdditiveModel.fit(x, np.ones(4000)).score(x).min() > 0.99
    assert quality.AdditiveModel.fit(x[:0], np.ones(0)).score(x).tolist() == [0.5] * 4000


def test_features_do_not_depend_on_the_batch():
    texts = [None, "", "A a!! a | b\nA\nA", *prose(1, 5), " \n "]
    one = np.concatenate([quality.features(pa.array([t], pa.string())) for t in texts])
    np.testing.assert_array_equal(one, quality.features(pa.array(texts)))
    np.testing.assert_array_equal(one[0], one[1])


def test_awkward_documents(spark):
    texts = [None, "", "x", "y " * 60_000, *prose(5, 30), "x"]
    ids = [None, 1, 2, 3, *range(4, 34), 2]
    docs = awkward(spark, texts, ids)
    labels = spark.createDataFrame([(2, 1), (2, 0), (3, None), (None, 1), (5, 0), (6, 1), (7, 1), (8, 0)], "doc_id long, quality int")
    found = quality.quality_scores(docs, labels).collect()
    assert len(found) == len(texts) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    assert {r.score for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(none_of(spark), labels).count() == 0
    kept = quality.drop_rejected(docs, labels, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == len(texts)
    assert quality.drop_rejected(docs, labels, threshold=1.1).count() == 0


def test_without_labels_nothing_is_dropped(spark):
    docs = awkward(spark, prose(6, 8))
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    kept_back = spark.range(8).selectExpr("id AS doc_id", "1 AS quality").where(held_out())
    for none in (labels.limit(0), labels.withColumn("quality", F.lit(None).cast("int")), kept_back):
        assert quality.drop_rejected(docs, none, threshold=0.7).count() == 8
