from __future__ import annotations

import itertools
import re

import numpy as np
import pytest
from samples import awkward, none_of, rows_of, space_words
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from compare import connect, differences
from ridgeway.llm import audit

COLUMNS = ("part", "filter_order", "step", *audit.AUDIT_COLUMNS)


def masks_of(docs):
    """The failing letters of each (doc_id, text), by the contract's words."""
    out = []
    for doc_id, text in docs:
        text = text or ""
        w = space_words(text)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t in docs),
        }
        out.append({f for f, failed in fails.items() if failed})
    return out


def expected(docs, parts, good, toxic):
    masks = masks_of(docs)
    rows = []
    for part in set(parts):
        here = [(m, g, t) for m, p, g, t in zip(masks, parts, good, toxic) if p == part]
        orders = list(itertools.permutations("ABCDE"))
        removed = {(o, k): [x for x in here if o[k] in x[0] and not x[0] & set(o[:k])] for o in orders for k in range(5)}
        shapley = {f: sum(len(removed[o, o.index(f)]) for o in orders) for f in "ABCDE"}
        for o in orders:
            for k, f in enumerate(o):
                gone = removed[o, k]
                kept = sum(not x[0] & set(o[: k + 1]) for x in here)
                failing = sum(f in x[0] for x in here)
                alone = sum(x[0] == {f} for x in here)
                rows.append(
                    (part, "".join(o), k + 1, kept, len(gone), failing - len(gone), alone)
                    + (sum(x[1] for x in gone), sum(x[2] for x in gone), shapley[f])
                )
    return sorted(rows, key=repr)


VARIED = " ".join(f"w{i}" for i in range(250))
TEXTS = [
    None, "", "a b", "a b", VARIED, VARIED, VARIED, VARIED + " #", "x " * 300, "X " * 300, "A" + "b" * 49, "A" + "b" * 48, "é" * 49 + "A", "é" * 50 + "A",
    "a\x1cb c " * 200, "A a\n" * 40_000, " \t\n", "a|b",
]


def test_every_case(spark):
    ids = [5, 4, 3, None, 9, 9, 2, 7, 8, 10, 11, 12, 13, 14, 15, 16, 17, None]
    parts = [None, "", "s", "s", "t", "t", "s", "t", "t", "s", "s", "s", "t", "t", "s", "t", "t", "s"]
    docs = awkward(spark, TEXTS, ids).drop("source")
    named = spark.createDataFrame(list(zip(ids, TEXTS, parts)), "doc_id long, text string, source string").repartition(3)
    named = named.withColumn("mask", F.lit(7)).withColumn("digest", F.lit("x")).withColumn("part", F.lit("y")).withColumn("n", F.lit(1))
    marks = [(9, 1, 0), (9, None, 1), (2, 1, None), (None, 1, 1), (99, 1, 1), (16, 0, 1), (8, 1, 1), (13, 2, 2)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    good, toxic = ([i in ok for i in ids] for ok in ({9, 2, 8}, {9, 16, 8}))
    found = audit.filter_audit(named, labels)
    assert rows_of(found, *COLUMNS) == expected(list(zip(ids, TEXTS)), [p or "" for p in parts], good, toxic)
    assert audit.filter_audit(docs.withColumn("source", F.lit(None).cast("string")), labels).select("part").distinct().collect() == [("",)]


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.filter_audit(none_of(spark), labels).count() == 0
    one = audit.filter_audit(awkward(spark, ["a"]), labels)
    assert one.agg(F.sum("good_lost"), F.sum("toxic_lost"), F.count("*")).first() == (0, 0, 600)


def test_a_query_and_its_twin(spark):
    sf = "/root/testdata/sf0.001"
    query = entry_point.queries()["op13_filter_audit"](spark, sf)
    assert differences(query, connect(sf), entry_point.oracle_sql()["op13_filter_audit"]) == []


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5])
def test_swaps_meet_every_order_once(size):
    order, met = list(range(size)), set()
    met.add(tuple(order))
    for level in audit.adjacent_swaps(size):
        order[level], order[level + 1] = order[level + 1], order[level]
        assert tuple(order) not in met
        met.add(tuple(order))
    assert len(met) == len(list(itertools.permutations(range(size))))


def test_a_swapped_diagram_is_the_function_in_the_new_order():
    leaves = np.random.default_rng(3).integers(0, 3, (16, 1))
    diagram = audit.Diagram(leaves)
    for level in [0, 2, 1, 2, 0, 1, 1]:
        diagram.swap(level)
        for mask in range(16):
            node = diagram.root
            for f in diagram.order:
                node = diagram.children[node][mask >> f & 1]
            assert diagram.value[node] == tuple(leaves[mask])


def test_equal_subfunctions_are_one_node():
    diagram = audit.Diagram(np.ones((32, 1), np.int64))
    assert [diagram.nodes(k) for k in range(5)] == [1] * 5 and diagram.value[diagram.root] == (32,)
    diagram.swap(2)
    assert [diagram.nodes(k) for k in range(5)] == [1] * 5
