from __future__ import annotations

import random
import zlib

import pytest
from samples import awkward, none_of
from pyspark.sql import functions as F

from ridgeway.llm import toxicity as tox

SCHEMA = "doc_id long, toxic int"


@pytest.mark.parametrize(
    "text, words",
    [
        (None, []),
        ("", []),
        (" \n!!", []),
        ("Idiot, IDIOT!!", ["idiot", "idiot"]),
        ("1d10t ldiot іdіоt ｉｄｉｏｔ i​diot", ["idiot"] * 5),
        ("$tup!d stup1d 5tupid", ["stupid"] * 3),
        ("c1own clown c|own", ["ciown"] * 3),
        ("the$$$ in%%% 1999 5", ["the", "in", "1999", "5"]),
        ("src5 l0ser m0r0n", ["srcs", "ioser", "moron"]),
    ],
)
def test_folding(text, words):
    assert tox.folded_words(text) == words


def slow_matches(words, weights):
    """Leftmost, then longest entry, in plain Python."""
    text, out, at = tox.marked(words), [], 0
    while at < len(text):
        here = [e for e in weights if text.startswith(e, at)]
        if here:
            entry = max(here, key=len)
            out.append((at + len(entry) - 1, entry, weights[entry]))
            at += len(entry)
        else:
            at += 1
    return out


def test_matches_are_the_longest_from_the_left():
    o, c = tox.OPEN, tox.CLOSE
    r = random.Random(3)
    for _ in range(300):
        words = ["".join(r.choice("ab") for _ in range(r.randint(1, 4))) for _ in range(r.randint(0, 12))]
        names = ["".join(r.choice("ab") for _ in range(r.randint(1, 3))) for _ in range(6)]
        weights = {o + n: 1.0 for n in names[:2]} | {o + n + c: 2.0 for n in names[2:4]} | {o + names[4] + c + o + names[5] + c: 0.0}
        lexicon = tox.Lexicon(weights)
        assert lexicon.matches(words, lexicon.automaton()) == slow_matches(words, weights)


def test_phrases_and_longer_entries_are_exceptions():
    o, c = tox.OPEN, tox.CLOSE
    lexicon = tox.Lexicon({f"{o}trash{c}": 3.0, f"{o}trash{c}{o}can{c}": 0.0, f"{o}mor": 2.0, f"{o}morning{c}": 0.0}, (-2.0, 1.0, 1.0))
    n, hits, weight = lexicon.measured(["trash", "a trash can", "tr4sh morning morx", None, "morn"])
    assert hits.tolist() == [1, 0, 2, 0, 1] and weight.tolist() == [3.0, 0.0, 5.0, 0.0, 2.0]
    score = lexicon.score(n, weight)
    assert score[0] > 0.5 > score[1] == score[3]


def test_length_counts():
    lexicon = tox.Lexicon(curve=(-4.0, 1.0, 1.0))
    short, long = lexicon.score(*(tox.np.array(x, float) for x in ([20, 20_000], [5, 5])))
    assert short > long


def planted(seed=5, n=900):
    """Ids, texts and labels: toxic texts hold words of a family or a whole word; some clean ones an innocent phrase."""
    r = random.Random(seed)
    plain = ["".join(r.choice("aeioubdgklmnprst") for _ in range(r.randint(3, 8))) for _ in range(500)]
    rows = []
    for i in range(n):
        words = [r.choice(plain) for _ in range(r.randint(10, 120))]
        label = int(i % 6 == 0)
        if label:
            for _ in range(r.randint(2, 4)):
                words.insert(r.randrange(len(words)), r.choice(["zorgvax", "quilpest" + r.choice(["a", "om", "eri", "u", "ta"])]))
        elif i % 10 == 0:
            at = r.randrange(len(words))
            words[at:at] = ["zorgvax", "garden"]
        rows.append((i, " ".join(words), label))
    return rows


def test_learns_words_families_and_exceptions(spark):
    rows = planted()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], SCHEMA)
    lexicon = tox.fit_lexicon(docs, labels)
    names = {tox.readable(e): w for e, w in lexicon.weights.items()}
    assert any("quiipest".startswith(e[:-1]) and w > 1 for e, w in names.items() if e.endswith("*"))
    assert names["zorgvax garden"] == 0.0
    found = {r.doc_id: r for r in tox.toxicity(docs, labels).collect()}
    unseen = [(i, y) for i, _, y in rows if found[i].held_out]
    assert len(unseen) > 100 and sum(found[i].predicted == y for i, y in unseen) / len(unseen) > 0.97
    disguised = docs.withColumn("text", F.expr("translate(text, 'oaeis', '0431$')"))
    caught = {r.doc_id: r.predicted for r in tox.toxicity(docs.unionByName(disguised.withColumn("doc_id", F.expr("doc_id + 10000"))), labels).collect()}
    toxic = [i for i, _, y in rows if y]
    assert sum(caught[i + 10000] for i in toxic) / len(toxic) > 0.9
    again = {r.doc_id: r.score for r in tox.toxicity(docs.repartition(7), labels.repartition(3)).collect()}
    assert again == {i: r.score for i, r in found.items()}


def test_awkward_rows(spark):
    texts = [t for _, t, _ in planted(n=120)] + [None, "", "zorgvax " * 60_000, "x " * 60_000, "zorgvax", "zorgvax"]
    ids = [*range(122), 2000, 2001, 2002, None]
    labels = spark.createDataFrame([(i % 130, int(i % 6 == 0)) for i in range(150)] + [(None, 1), (3, None)], SCHEMA)
    rows = tox.toxicity(awkward(spark, texts, ids), labels).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    for r in rows:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert r.held_out == (zlib.crc32(key.encode()) % 5 == 0)
    assert {r.n_words for r in rows if r.doc_id in (120, 121)} == {0}
    assert len({r.score for r in rows if r.doc_id in (2002, None) and r.n_words == 1}) == 1
    assert tox.toxicity(none_of(spark), labels).count() == 0


def test_without_labels_nothing_is_toxic(spark):
    docs = awkward(spark, ["a b", None, "idiot"])
    for labels in ([], [(0, None)], [(0, 0), (1, 0), (2, 0)]):
        rows = tox.toxicity(docs, spark.createDataFrame(labels, SCHEMA)).collect()
        assert [r.predicted for r in rows] == [0, 0, 0] and max(r.score for r in rows) < 1e-9


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = tox.toxicity(docs, labels).join(labels, "doc_id").where("held_out")
    n = {(r.toxic, r.predicted): r["count"] for r in found.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.9 and n.get((0, 1), 0) / (n[0, 0] + n.get((0, 1), 0)) < 0.005
