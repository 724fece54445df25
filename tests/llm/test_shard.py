from __future__ import annotations

import zlib
from collections import Counter

import pytest
from samples import awkward, none_of
from pyspark.sql import functions as F

from ridgeway.llm import shard


def test_contract(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(5)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = shard.shards(docs).collect()
    assert len(rows) == len(texts) and {r.law for r in rows} == {"key"}
    for r in rows:
        body = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(body) + 1, zlib.crc32(body))
        assert r.grown_shard in (r.shard, 16)
    by_shard = Counter(r.shard for r in rows)
    for s, n in by_shard.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))
    assert set(by_shard) == set(range(16)) and max(by_shard.values()) < 2 * min(by_shard.values())
    moved = sum(r.grown_shard == 16 for r in rows) / len(rows)
    assert 0.03 < moved < 0.1


def test_the_key_alone_decides(spark):
    docs = awkward(spark, ["a", "b", None, "", "a"], [1, 2, 3, None, 1])
    again = awkward(spark, ["x", "y", "z", "q", "w"], [3, 1, None, 2, 1])
    a, b = ({(r.doc_id, r.shard, r.grown_shard) for r in shard.shards(d).collect()} for d in (docs, again))
    assert a == b
    sizes = {r.doc_id: (r.size, r.text_crc32) for r in shard.shards(docs).collect()}
    assert sizes[3] == (1, 0) and sizes[None] == (1, 0)
    assert shard.shards(none_of(spark)).count() == 0


def test_weights(spark):
    keys = spark.range(20_000).select(shard.rendezvous(F.col("id"), [1.0, 2.0, 5.0]).alias("s"))
    n = {r.s: r["count"] for r in keys.groupBy("s").count().collect()}
    for s, w in enumerate((1, 2, 5)):
        assert abs(n[s] / 20_000 - w / 8) < 0.02
    with pytest.raises(ValueError):
        shard.rendezvous(F.col("id"), [1.0, 0.0])


def test_one_key_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(shard, "BLOCK_BITS", 3)
    docs = spark.range(0, 500, 1, 4).select(F.lit(7).alias("doc_id"), F.lit("same").alias("text"))
    rows = shard.shards(docs).collect()
    assert sorted(r.slot for r in rows) == list(range(500)) and len({r.shard for r in rows}) == 1
