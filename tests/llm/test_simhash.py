from __future__ import annotations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import SF, awkward, lower_ascii, none_of, prose, rows_of, space_words

from ridgeway.llm import simhash
from ridgeway.llm.components import components


def fingerprint(text, width=3):
    words = space_words(lower_ascii(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def groups(values, radius):
    """The least index reachable from each value."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def expected(rows, radius=3):
    prints = [fingerprint(t) for _, t in rows]
    found = groups(prints, radius)
    least = {}
    for (doc_id, _), root in zip(rows, found):
        if doc_id is not None:
            least[root] = min(doc_id, least.get(root, doc_id))
    return sorted(((d, f"{p:016x}", least.get(r)) for (d, _), p, r in zip(rows, prints, found)), key=repr)


COLUMNS = ("doc_id", "fingerprint", "component_id")


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(simhash.simhash_groups(docs), *COLUMNS) == expected(rows)


def test_awkward_documents(spark):
    base = prose(1, 12)
    texts = [None, "", " \n\t", "One", "one", "ONE two", *base, *base[:4], *(t + " more" for t in base), "ÀB c\x1cd"]
    ids = [None if i in (3, 9) else i % 30 for i in range(len(texts))]
    docs = awkward(spark, texts, ids)
    assert rows_of(simhash.simhash_groups(docs), *COLUMNS) == expected(list(zip(ids, texts)))
    assert simhash.simhash_groups(none_of(spark)).count() == 0


def test_texts_longer_than_a_step(monkeypatch):
    monkeypatch.setattr(simhash, "HASHES", 7)
    texts = [*prose(2, 5), "", "a b", " ".join(prose(3, 30))]
    found = simhash.fingerprint_texts([t.encode() for t in texts], 3)
    assert found.tolist() == [fingerprint(t) for t in texts]


@settings(deadline=None, max_examples=25)
@given(st.integers(0, 2**32), st.integers(1, 5))
def test_buckets_against_all_pairs(seed, radius):
    r = np.random.default_rng(seed)
    values = np.repeat(r.integers(0, 1 << 63, 30, dtype=np.uint64), 6)
    for i in range(len(values)):
        for bit in r.integers(0, 64, r.integers(0, 4)):
            values[i] ^= np.uint64(1) << np.uint64(bit)
    bounds = np.array([0, 0, 1, 5, 69, 180])
    want = []
    for a, b in zip(bounds, bounds[1:]):
        want += [int(a) + g for g in groups([int(v) for v in values[a:b]], radius)]
    assert simhash.bucket_roots(values, bounds, radius).tolist() == want


def test_links_across_chunks_and_tables(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 8)
    r = np.random.default_rng(5)
    values = {int(v) for v in r.integers(0, 1 << 62, 40)}
    for v in list(values)[:10]:
        values |= {v ^ (1 << int(a)) ^ (1 << int(b)) for a, b in r.integers(0, 63, (12, 2))}
    values = sorted(values)
    links = simhash.near_links(spark.createDataFrame([(v,) for v in values], "fp long"), 3)
    roots = {r.node: r.root for r in components(links, "a", "b").collect()}
    want = groups(values, 3)
    assert [roots.get(v, v) for v in values] == [values[w] for w in want]


def test_overfull_buckets_meet_further_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 32)
    monkeypatch.setattr(simhash, "FULL", 64)
    r = np.random.default_rng(8)
    # all agree in the first two of five blocks; some are within the radius, others just beyond it
    values = {int(v) << 25 for v in r.integers(0, 1 << 38, 500)}
    for v in list(values)[:150]:
        for many in r.integers(1, 5, 4):
            values.add(v ^ sum(1 << int(k) for k in r.choice(np.arange(25, 63), many, replace=False)))
    # and so many at close quarters that one more block is not enough
    values |= {int(v) << 40 for v in r.choice(1 << 9, 200, replace=False)}
    values = sorted(values)
    rows = spark.createDataFrame([(v,) for v in values], "fp long")
    roots = {r.node: r.root for r in components(simhash.near_links(rows, 3), "a", "b").collect()}
    want = groups(values, 3)
    assert [roots.get(v, v) for v in values] == [values[w] for w in want]


def test_an_overfull_bucket_sends_few_rows(spark):
    n = 200_000
    rows = spark.range(n).select(F.shiftleft(F.xxhash64("id"), 25).alias("fp")).distinct()
    lists = simhash.shared_buckets(rows, 3).select(F.size("fps").alias("n"))
    assert lists.agg(F.sum("n"), F.max("n")).first()[0] <= 20 * n
    assert lists.agg(F.max("n")).first()[0] <= 2 * simhash.CHUNK


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b")
    want = [(i, 0) for i in range(61)] + [(1000 + i, 1000) for i in range(200)]
    assert rows_of(found, "node", "root") == sorted(want, key=repr)


def test_one_row_of_each_group_stays(spark):
    base = prose(7, 6)
    texts, ids = [*base, *base, "", None, base[0]], [*range(6), *range(10, 16), 20, 21, 0]
    docs = awkward(spark, texts, ids)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    want = {d for d, _, c in expected(list(zip(ids, texts))) if d == c}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert simhash.keep_one(none_of(spark)).count() == 0


@pytest.mark.parametrize("width", [1, 2, 5])
def test_other_shingles(width):
    texts = prose(width, 6)
    assert simhash.fingerprint_texts([t.encode() for t in texts], width).tolist() == [fingerprint(t, width) for t in texts]
