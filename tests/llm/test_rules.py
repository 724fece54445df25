from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from samples import awkward, none_of, prose, rows_of, space_words
from pyspark.sql import functions as F

from ridgeway.llm import rules
from ridgeway.llm.textstats import TextStats

COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def expected(doc_id, text):
    w = space_words(text)
    windows = list(zip(w, w[1:], w[2:]))
    often = Counter(windows)
    inside = {i + j for i, k in enumerate(windows) if often[k] > 1 for j in range(3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if space_words(line):
            again += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return (doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(inside), failed)


def test_counts(spark):
    texts = [None, "", "a a a a", " \n\n a\n a\na\n\x0bb\x1cc", "é|é #*$%&|<>!", *prose(2, 40, 80, 6), *prose(3, 20), "x y " * 40_000]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    ids = [None if i == 5 else i % 60 for i in range(len(texts))]
    found = rules.judged(awkward(spark, texts, ids), labels)
    assert rows_of(found, *COLUMNS) == sorted((expected(i, t) for i, t in zip(ids, texts)), key=repr)
    assert found.where("base_failed and kept").count() == 0
    assert found.where("not base_failed and kept <> (probability >= 0.5)").count() == 0
    assert rules.judged(none_of(spark), labels).count() == 0


def test_without_labels_the_rules_decide(spark):
    texts = prose(4, 30, 80)
    found = rules.judged(awkward(spark, texts), spark.createDataFrame([], "doc_id long, quality int"))
    assert found.where("kept <> (not base_failed)").count() == 0


def test_verdicts_follow_the_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = rules.judged(docs, labels).join(labels, "doc_id").where("not base_failed")
    right, n = found.agg(F.sum((F.col("kept") == (F.col("quality") == 1)).cast("int")), F.count("*")).first()
    assert right / n > 0.99


def test_regression_value_is_the_weighted_sum():
    texts = [None, "", "ab", *prose(6, 8), "éa b"]
    stats = TextStats(pa.array(texts))
    model = rules.HashedRegression(np.random.default_rng(1).normal(size=2 * rules.SLOTS))
    want = [float((model.weights[s] * v).sum()) for s, v in rules.hashed_shares(stats)]
    np.testing.assert_allclose(model.value(stats), want, atol=1e-5)


def test_calibration_recovers_a_logistic_curve():
    r = np.random.default_rng(8)
    z = r.normal(size=20_000) * 5
    y = (r.uniform(size=len(z)) < 1 / (1 + np.exp(-(0.7 * z - 1)))).astype(float)
    slope, offset = rules.calibrated(z, y)
    assert abs(slope - 0.7) < 0.05 and abs(offset + 1) < 0.1
    weighted = rules.calibrated(np.repeat(z, 2), np.tile([1.0, 0.0], len(z)), np.stack([y, 1 - y], 1).ravel())
    np.testing.assert_allclose(weighted, (slope, offset), atol=1e-3)
