from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import awkward, none_of, prose
from tokenizers import Tokenizer

from ridgeway.llm import pack
from ridgeway.llm.tokens import WordEncoder

TEXTS = [
    "<|endoftext|> a<|startoftext|>b", "I'm you're 'tis x's A.B 12ab", "ÉCOLE Straße ÿ ÀÉ!!", "ΣΑΣ İstanbul ǅ ﬁ",
    "a\x1cb\u00a0c\u2028d\u0085e", "q  \n\n z", "e\u0301 é", "", " ", "×÷ a×b", "x" * 3000, "漢字かな", "🙂🙂 ok", *prose(3, 5),
]


def test_ids_are_the_tokenizers(spark):
    path = pack.tokenizer_path()
    whole = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        encoder = WordEncoder(f.read())
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for text in [*TEXTS, *docs, *TEXTS]:
        got = np.frombuffer(encoder.ids(text), "<u4").tolist()
        assert got == whole.encode(text, add_special_tokens=False).ids, text[:50]


def unpacked(patterns, capacity):
    counts = np.zeros(capacity + 1, np.int64)
    for content, times in patterns:
        assert times > 0 and sum(v * a for v, a in content) <= capacity
        for v, a in content:
            counts[v] += a * times
    return counts


@settings(deadline=None, max_examples=25)
@given(st.integers(0, 2**32), st.sampled_from([7, 64, 200]))
def test_patterns_hold_the_histogram(seed, capacity):
    r = np.random.default_rng(seed)
    counts = np.zeros(capacity + 1, np.int64)
    for v in r.integers(1, capacity + 1, r.integers(1, 40)):
        counts[v] += r.integers(1, 50)
    for solve in (pack.pack_histogram, pack.best_fit):
        patterns = solve(counts)
        assert unpacked(patterns, capacity).tolist() == counts.tolist()
    least = -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)
    assert sum(n for _, n in pack.pack_histogram(counts)) <= 2 * least


def test_few_sequences():
    r = np.random.default_rng(1)
    counts = np.bincount(np.clip(r.gamma(2, 300, 50_000).astype(int) + 1, 1, 2048), minlength=2049)
    used = sum(n for _, n in pack.pack_histogram(counts))
    tokens = int((counts * np.arange(2049)).sum())
    assert used <= 1.001 * tokens / 2048 + 1
    # the program itself, not the filling up after it, covers most tokens
    solved = pack._configurations(counts)
    assert sum(int(n + 1e-6) * sum(v * a for v, a in c) for c, n in solved.items()) > 0.8 * tokens


@pytest.mark.parametrize("lengths", [(1000, 600, 448), (900, 700, 448), (1200, 848)])
def test_spikes_that_fit_exactly(lengths):
    counts = np.zeros(2049, np.int64)
    counts[list(lengths)] = 9000
    patterns = pack.pack_histogram(counts)
    assert unpacked(patterns, 2048).tolist() == counts.tolist()
    assert sum(n for _, n in patterns) <= 1.002 * 9000 + 1


@pytest.mark.parametrize("capacity", [2048, 16])
def test_contract(spark, capacity):
    texts = [*TEXTS, None, TEXTS[-1], " ".join(prose(9, 40))]
    ids = [None if i == 3 else i % 17 for i in range(len(texts))]
    docs = awkward(spark, texts, ids)
    whole = Tokenizer.from_file(pack.tokenizer_path())
    want = []
    for d, t in zip(ids, texts):
        body = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k, a in enumerate(range(0, len(body), capacity)):
            part = body[a : a + capacity]
            want.append((d, k, a, len(part), zlib.crc32(part.tobytes())))
    rows = pack.pack(docs, capacity).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(want, key=repr)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity


def test_empty_table(spark):
    assert pack.pack(none_of(spark)).count() == 0
