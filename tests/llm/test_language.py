from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import awkward, none_of
from pyspark.sql import functions as F

from ridgeway.llm import language


@settings(deadline=None, max_examples=30)
@given(st.integers(0, 2**32), st.integers(1, 4))
def test_viterbi_finds_the_best_path(seed, k):
    r = np.random.default_rng(seed)
    counts = r.integers(0, 200, 5)
    scores, penalty = r.normal(0, 2, (counts.sum(), k)), 2.5
    labels = language.viterbi(scores, counts, penalty)
    for a, b in zip(np.cumsum(counts) - counts, np.cumsum(counts)):
        if a < b:
            best = scores[a]
            for row in scores[a + 1 : b]:
                best = np.maximum(best, best.max() - penalty) + row
            own = labels[a:b]
            value = scores[np.arange(a, b), own].sum() - penalty * (np.diff(own) != 0).sum()
            assert abs(value - best.max()) < 1e-8


def test_word_slots_do_not_depend_on_the_neighbours():
    def of(texts):
        out = {}
        words = language.Words(pa.array(texts))
        for part, orders in words.slots():
            for w, (a, b) in enumerate(zip(words.starts[part], words.ends[part])):
                out[words.data[a:b].tobytes()] = [tuple(s[f[w] : l[w]]) for s, f, l in orders]
        return out

    alone, together = of(["die"]), of([None, "x die, die\tdie", "", "die"])
    assert together[b"die"] == alone[b"die"] and len(alone[b"die"][0]) == 3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 150 and right / n > 0.98


def test_mixed_texts_and_scripts(spark):
    english, german, greek = "the house is on the hill and there they are ", "das Haus und die Straße sind nicht weit ", "το σπίτι είναι στο λόφο και εκεί "
    rows = [(i, t * 5, lang) for i in range(40) for t, lang in ((english, "en"), (german, "de"), (greek, "el"))]
    rows = [(3 * i + k, t, lang) for k, (i, t, lang) in enumerate(rows)]
    learnt = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    asked = [(9001, english * 3 + german * 4, None), (9002, greek + english * 2, None), (9003, " 12 .,; 3", None), (9004, None, "en"), (9005, "", "en"), (9006, "Привет", None)]
    found = language.languages(learnt.unionByName(spark.createDataFrame(asked, learnt.schema)))
    by_id = {r.doc_id: r for r in found.where("doc_id > 9000").collect()}
    assert by_id[9001].lang_pred == "de" and [s.lang for s in by_id[9001].spans] == ["en", "de"]
    assert by_id[9001].spans[0].words == 30 and 0 < by_id[9001].score < 1
    assert [s.lang for s in by_id[9002].spans] == ["el", "en"]
    for i in (9003, 9004, 9005):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].spans) == ("und", 0.0, [])
    assert by_id[9006].lang_pred in ("en", "de", "el")  # no language uses the script


def test_awkward_documents(spark):
    texts = [None, "", "x", "the house " * 3000, "the", "the", "漢字 かな 한글 عربى"]
    found = language.languages(awkward(spark, texts, [1, 1, None, 4, 5, 5, 6])).collect()
    assert len(found) == len(texts) and all(0 <= r.score <= 1 for r in found)
    unlearnt = language.languages(awkward(spark, texts).withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlearnt.collect()} == {"und"}
    assert language.languages(none_of(spark)).count() == 0


def test_the_sample_does_not_depend_on_the_layout(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    a, b = (
        {r.doc_id: (r.lang_pred, r.score) for r in language.languages(docs.repartition(n, "source"), rows=20).collect()}
        for n in (1, 7)
    )
    assert a == b
