from __future__ import annotations

import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, differences
from samples import SF, awkward, none_of, space_words
from test_decontaminate import expected as contaminated
from test_lines import expected as without_copies
from test_simhash import expected as grouped

import __spark_entry__ as entry_point
import corpus_pipeline
from ridgeway.llm import pack, quality, queries

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_and_sql(spark, con, name):
    assert differences(queries.queries()[name](spark, SF), con, queries.oracle_sql()[name]) == []


def test_one_query_per_operator():
    names = [n for n in entry_point.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_point.queries() and list(STAGES) == [
        "quality", "line_dedup", "near_dedup", "decontaminate", "pack"
    ]


def test_the_rest_does_not_import_the_package():
    code = "import sys, ridgeway.queries; sys.exit(any(m.startswith('ridgeway.llm') for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], check=False).returncode == 0


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def pairs(df):
        return [(r.doc_id, r.text) for r in df.collect()]

    model = quality.fit_quality(docs, labels)
    start = pairs(docs)
    good = model.score(quality.features(pa.array([t for _, t in start]))) >= 0.7
    first = STAGES["quality"](spark, docs, SF).cache()
    assert first.columns == docs.columns
    assert sorted(pairs(first)) == sorted(r for r, g in zip(start, good) if g) and 0 < good.sum() < len(good)

    texts = dict(pairs(first))
    second = STAGES["line_dedup"](spark, first, SF).cache()
    # only lines that occur in two places can be deleted; all runs of few documents are quick to list
    shared = {}
    for d, t in texts.items():
        for line in t.split("\n"):
            shared.setdefault(line, set()).add(d)
    twice = [(d, t) for d, t in texts.items() if any(len(shared[x]) > 1 or t.split("\n").count(x) > 1 for x in t.split("\n"))]
    small = [(d, t) for d, t in twice if t.count("\n") < 60]
    want = {d: t for d, t, _, _ in without_copies(small, 50)}
    if len(small) == len(twice):
        assert {d: t for d, t in pairs(second) if d in want} == want
    after = dict(pairs(second))
    assert set(after) == set(texts) and all(len(space_words(after[d])) <= len(space_words(t)) for d, t in texts.items())

    third = STAGES["near_dedup"](spark, second, SF).cache()
    keep = {d for d, _, c in grouped(pairs(second)) if d == c}
    assert sorted(pairs(third)) == sorted((d, t) for d, t in after.items() if d in keep)

    fourth = STAGES["decontaminate"](spark, third, SF).cache()
    clean = {d for d, *_, bad in contaminated(pairs(third), items) if not bad}
    assert sorted(pairs(fourth)) == sorted((d, t) for d, t in pairs(third) if d in clean)

    last = STAGES["pack"](spark, fourth, SF)
    whole = corpus_pipeline.run(spark, SF)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, last.select(columns).collect())) == sorted(map(tuple, whole.select(columns).collect()))
    assert {r.doc_id for r in last.collect()} == clean
    counts = np.bincount([r.length for r in last.collect()], minlength=2049)
    assert len({r.sequence_id for r in last.collect()}) == sum(n for _, n in pack.pack_histogram(counts))


def test_stages_of_awkward_tables(spark):
    texts = [None, "", "a b c", "a b c", "word " * 80, "word " * 80 + "\nend"]
    docs = awkward(spark, texts, [1, None, 3, 3, 5, 6])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none_of(spark), SF).count() == 0
        found = stage(spark, docs, SF)
        assert name == "pack" or found.schema.simpleString() == docs.schema.simpleString()
        found.collect()


def without_copies_quick(rows, min_words):
    """The texts after deletion, from the shortest runs from and up to each line, as in OP7."""
    seen, out = set(), {}
    for d, text in sorted(rows):
        body = text.split("\n")
        words = [len(space_words(x)) for x in body]
        runs = set()
        for at in range(len(body)):
            for step in (1, -1):
                total, end = 0, at
                while 0 <= end < len(body):
                    total += words[end]
                    if total >= min_words:
                        runs.add((min(at, end), max(at, end)))
                        break
                    end += step
        cut = set()
        for a, b in sorted(runs):
            run = tuple(body[a : b + 1])
            if run in seen:
                cut.update(range(a, b + 1))
            seen.add(run)
        out[d] = "\n".join(x for i, x in enumerate(body) if i not in cut)
    return out


def test_line_dedup_of_every_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    r = np.random.default_rng(7)
    # documents of 60 lines and more that share lines are compared too
    stock = [f"line {i} of five words" for i in range(90)]
    long = [(10**9 + k, "\n".join(stock[a:])) for k, a in enumerate(r.integers(0, 25, 6).tolist())]
    both = docs.unionByName(spark.createDataFrame(long, docs.schema))
    start = [(x.doc_id, x.text) for x in both.collect()]
    want = without_copies_quick(start, 50)
    assert {x.doc_id: x.text for x in STAGES["line_dedup"](spark, both, SF).collect()} == want
    assert sum(want[d] != t for d, t in start) >= 5
