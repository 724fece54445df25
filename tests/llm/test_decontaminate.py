from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from samples import awkward, lower_ascii, none_of, prose, rows_of

from ridgeway.llm import decontaminate

COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))


def expected(docs, items, window=10):
    windows = {}
    for item_id, text in items:
        w = words_of(text)
        if w:
            n = min(window, len(w))
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i : i + n]), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        w, hit, found = words_of(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        ids = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=repr)


def table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def case(seed):
    r = random.Random(seed)
    items = [(i, t) for i, t in enumerate(prose(seed, 25, 12, 60))]
    items += [(100, "lone"), (101, "Two words"), (102, None), (103, " ,. "), (None, "without an id here"), (2, items[2][1])]
    texts = prose(seed + 1, 30, 60, 60)
    for k in range(0, 30, 2):
        w = words_of(r.choice(items[:25])[1])
        a = r.randrange(max(1, len(w)))
        texts[k] += " " + "; ".join(w[a : a + r.randint(1, 20)]).upper() + " " + texts[(k * 7) % 30]
    texts += [None, "", "LONE. two\nwords two words", "x without AN id here y", texts[0]]
    return texts, items


@pytest.mark.parametrize("window", [10, 3])
def test_against_all_windows(spark, window):
    texts, items = case(window)
    ids = [None if i == 4 else i % 33 for i in range(len(texts))]
    found = decontaminate.contamination(awkward(spark, texts, ids), table(spark, items), window)
    assert rows_of(found, *COLUMNS) == expected(list(zip(ids, texts)), items, window)


def test_false_hits_of_the_bit_table_do_not_count(spark):
    texts, items = case(3)
    found = decontaminate.contamination(awkward(spark, texts), table(spark, items), filter_bits=64)
    assert rows_of(found, *COLUMNS) == expected(list(enumerate(texts)), items)


def test_empty_tables(spark):
    texts, items = case(5)
    assert decontaminate.contamination(none_of(spark), table(spark, items)).count() == 0
    found = decontaminate.contamination(awkward(spark, texts), table(spark, []))
    assert rows_of(found, *COLUMNS) == expected(list(enumerate(texts)), [])


def test_every_shared_span_keeps_a_common_gram():
    r = np.random.default_rng(1)
    for length in range(1, 13):
        for _ in range(20):
            a, b = (r.integers(1, 4, 80).astype(np.uint64) for _ in range(2))  # many ties
            i, j = r.integers(0, 80 - length, 2)
            b[j : j + length] = a[i : i + length]
            owner, k = np.zeros(80, np.int64), (length + 1) // 2
            kept = [set(decontaminate.kept_grams(x, owner, length)[0].tolist()) for x in (a, b)]
            assert any(i + d in kept[0] and j + d in kept[1] for d in range(length - k + 1))


def test_only_contaminated_rows_go(spark):
    texts, items = case(7)
    docs = awkward(spark, texts, [i % 20 for i in range(len(texts))])
    clean = decontaminate.drop_contaminated(docs, table(spark, items))
    assert clean.columns == docs.columns
    bad = {t for t in texts if expected([(0, t)], items)[0][5]}
    want = sorted(repr((i % 20, t)) for i, t in enumerate(texts) if t not in bad)
    assert sorted(repr((r.doc_id, r.text)) for r in clean.collect()) == want
