from __future__ import annotations

import random

import pytest
from samples import awkward, none_of, rows_of, space_words

from ridgeway.llm import lines


def expected(rows, min_words):
    """Lines in a run of at least ``min_words`` words that occurs earlier; equal rows are one document."""
    documents = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    texts = [(d, t.split("\n") if t is not None else []) for d, t in documents]
    seen, gone = set(), {}
    for n, (_, body) in enumerate(texts):
        for a in range(len(body)):
            for b in range(a + 1, len(body) + 1):
                run = tuple(body[a:b])
                if sum(len(space_words(x)) for x in run) >= min_words:
                    if run in seen:
                        gone.setdefault(n, set()).update(range(a, b))
                    seen.add(run)
    out = {}
    for n, (d, t) in enumerate(documents):
        body, cut = texts[n][1], gone.get(n, set())
        kept = None if t is None else "\n".join(x for i, x in enumerate(body) if i not in cut)
        out[d, t] = (d, kept, len(body), len(cut))
    return sorted((out[r] for r in rows), key=repr)


def run(spark, rows, min_words):
    docs = awkward(spark, [t for _, t in rows], [d for d, _ in rows])
    found = lines.dedup_lines(docs, min_words, counts=("n_lines", "n_deleted"))
    assert found.columns == [*docs.columns, "n_lines", "n_deleted"]
    return rows_of(found, "doc_id", "text", "n_lines", "n_deleted")


@pytest.mark.parametrize("seed, min_words", [(1, 1), (2, 3), (3, 7)])
def test_against_all_runs(spark, seed, min_words):
    r = random.Random(seed)
    stock = ["", "a", "b c", "d e f", "g", " ", "h i"]
    rows = [(i, "\n".join(r.choice(stock) for _ in range(r.randint(1, 14)))) for i in range(14)]
    rows += [(30, None), (31, ""), (None, rows[3][1]), (5, rows[5][1]), (40, rows[6][1]), (41, "only one here")]
    assert run(spark, rows, min_words) == expected(rows, min_words)


def test_long_runs_need_several_doublings(spark):
    shared = "\n".join(f"w{i}" for i in range(23))
    rows = [(1, f"x\n{shared}\ny"), (2, f"{shared}\nz"), (3, "q\n" + shared), (4, shared.replace("w11", "v"))]
    found = {d: (t, n) for d, t, _, n in run(spark, rows, 20)}
    assert found == {1: (rows[0][1], 0), 2: ("z", 23), 3: ("q", 23), 4: (rows[3][1], 0)}


def test_one_line_passages(spark):
    passage = " ".join(f"word{i}" for i in range(51))
    rows = [(i, f"own {i}\n{passage}\nend {i}") for i in range(6)]
    found = run(spark, rows, 50)
    assert sum(passage in t for _, t, _, _ in found) == 1 and sum(n for *_, n in found) == 5


def test_nothing_to_do(spark):
    assert lines.dedup_lines(none_of(spark)).count() == 0
    rows = [(1, "a b"), (2, None), (3, "")]
    assert run(spark, rows, 50) == expected(rows, 50)
