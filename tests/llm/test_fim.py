from __future__ import annotations

import hashlib

import pytest
from samples import awkward, none_of, prose, rows_of
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from compare import connect, differences
from ridgeway.llm import common, fim

COLUMNS = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    text = text or ""
    digits = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digits[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    if h4 % 100 < 20:
        form, out = "spm", f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    else:
        form, out = "psm", f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"
    return doc_id, n, form, a, b - a, sha(out), sha(text)


TEXTS = [
    None, "", "a", "é", "ab", "has <P> in it", "<M>", "<S", "S><P", "<" * 50, "<S<P<M>"[:-1] * 9, "😀é́\n\x00 b" * 30,
    "same text", "same text", "long 😀 " * 30_000, *prose(12, 30),
]


@pytest.mark.parametrize("most", [fim.SLICE, 64])
def test_every_case(spark, monkeypatch, most):
    monkeypatch.setattr(fim, "SLICE", most)
    ids = [None if i == 7 else i % 37 for i in range(len(TEXTS))]
    found = fim.digests(awkward(spark, TEXTS, ids))
    assert rows_of(found, *COLUMNS) == sorted((expected(i, t) for i, t in zip(ids, TEXTS)), key=repr)
    assert {r.form for r in found.collect()} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    assert fim.digests(none_of(spark)).count() == 0 and fim.digests(none_of(spark)).columns == list(COLUMNS)


def test_marks_that_only_meet_at_the_cuts_are_told_apart(spark):
    pieces = ["<", "<S", "S>", "P>", "M>", "<M", ">", "a<P", ""]
    rows = [(p, m, s) for p in pieces for m in pieces for s in pieces]
    df = spark.createDataFrame(rows, "p string, m string, s string")
    psm = F.concat(F.lit("<P>"), "p", F.lit("<S>"), "s", F.lit("<M>"), "m")
    spm = F.concat(F.lit("<S>"), "s", F.lit("<P>"), "p", F.lit("<M>"), "m")
    whole = F.concat("p", "m", "s")
    inside = [F.instr(c, mark) > 0 for c in ("p", "m", "s") for mark in ("<P>", "<S>", "<M>")]
    df = df.where(~F.greatest(*inside))
    wrong = (fim.restored(psm, F.lit("psm")) != whole) | (fim.restored(spm, F.lit("spm")) != whole)
    assert df.where(wrong).count() == 0


def test_query_and_twin(spark):
    sf = "/root/testdata/sf0.01"
    query = entry_point.queries()["op12_fill_in_middle"](spark, sf)
    assert differences(query, connect(sf), entry_point.oracle_sql()["op12_fill_in_middle"]) == []
    assert query.where("output_sha256 = restored_sha256 and form <> 'plain' and n > 0").count() == 0
    assert common.read(spark, sf, "documents").count() == query.count()
