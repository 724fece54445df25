from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from samples import SF, awkward, none_of, prose, rows_of
from pyspark.sql import functions as F

from ridgeway.llm import private

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            right = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if right:
                found.append((kind, m.start(), m.end()))
    return found


def expected(doc_id, text):
    found = base(text)
    listed = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
    counts = [sum(k == kind for k, _, _ in found) for kind in PATTERNS]
    return (doc_id, *counts, hashlib.sha256(listed.encode()).hexdigest())


COLUMNS = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
PIECES = [
    "a.b@c.de", "x@y", "x@y.z%q@r.s-t.u", "@", "1.2.3.4", "999.1.1.1.5.6.7.8", "0255.0.00.1", "1.2.3.4.5.6.7.8.9",
    "4111 1111-1111 1111", "4111111111111111", "41111111111111112", "4111  1111 1111 1111", "5 4111111111111111", "12-",
    "+1 (583) 555-6359", "+123", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "++44 20 7946 0958)", "é", "😀", " ", "\n", "-", ".", "7",
]


def test_base_spans(spark):
    r = random.Random(4)
    texts = ["".join(r.choice(PIECES) + r.choice(["", " ", " and "]) for _ in range(r.randint(1, 12))) for _ in range(400)]
    texts += [None, "", "no data", *PIECES]
    ids = [None if i == 7 else i % 350 for i in range(len(texts))]
    found = private.private_spans(awkward(spark, texts, ids))
    assert rows_of(found, *COLUMNS) == sorted((expected(i, t) for i, t in zip(ids, texts)), key=repr)
    for row in found.collect():  # base spans stay, none touch an added one, all are in order
        spans = [s.split(":") for s in row.spans.split(",") if s]
        spans = [(list(PATTERNS).index(k), int(a), int(b)) for k, a, b in spans]
        assert spans == sorted(spans)


def test_long_runs_need_neither_stack_nor_squares(spark):
    texts = ["1" * 50_000, "1 " * 50_000, "a" * 100_000, "a." * 50_000 + "@", "x@" + "a." * 40_000 + "b", "+" + "1" * 50_000]
    found = private.private_spans(awkward(spark, texts))
    assert rows_of(found, *COLUMNS) == sorted((expected(i, t) for i, t in enumerate(texts)), key=repr)


def test_candidates_like_the_base_are_added(spark):
    r = random.Random(9)

    def card():
        digits = "4" + "".join(r.choice("0123456789") for _ in range(14))
        return next(digits + c for c in "0123456789" if luhn(digits + c))

    texts = [f"word card {card()} more" for _ in range(300)]
    texts += [f"word order {r.randrange(10**12, 10**13)} more" for _ in range(300)]
    asked = "the card 53820953013749 4111111111111111 goes"  # one run of 30 digits, which fails
    found = {t: s for t, s in private.private_spans(awkward(spark, [*texts, asked])).join(
        awkward(spark, [*texts, asked]).select("doc_id", "text"), "doc_id").select("text", "spans").collect()}
    assert base(asked) == [] and found[asked] == "card:24:40"
    assert all(not s for t, s in found.items() if " order " in t)


def test_trees_as_numbers_and_as_columns(spark):
    r = np.random.default_rng(2)
    x = r.integers(0, 6, (300, len(private.FEATURES))).astype(float)
    trees = private.BoostedTrees.fit(x, (x[:, 1] > 2) * 3.0, np.full(300, 3.0), rounds=5)
    names = [f"f{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame([[int(v) for v in row] for row in x], ", ".join(f"{n} int" for n in names))
    got = df.select(trees.probability([F.col(n) for n in names])).toPandas().iloc[:, 0]
    np.testing.assert_allclose(np.sort(got), np.sort(1 / (1 + np.exp(-trees.value(x)))))
    assert ((trees.value(x) > 0) == (x[:, 1] > 2)).all()


def test_empty_table(spark):
    assert private.private_spans(none_of(spark)).count() == 0


def right_card(r):
    digits = "4" + "".join(r.choice("0123456789") for _ in range(14))
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def in_fours(digits):
    return " ".join(digits[i : i + 4] for i in range(0, 16, 4))


def spans_by_text(spark, texts):
    docs = awkward(spark, texts)
    found = private.private_spans(docs).join(docs.select("doc_id", "text"), "doc_id")
    return dict(found.select("text", "spans").collect())


def test_cards_with_digits_beside_them(spark):
    r = random.Random(21)
    forms = ["card {} 123 end", "card 12 {} end", "card {} 12/27 end"]
    texts = {form.format(c): c for form in forms for c in (in_fours(right_card(r)) for _ in range(60))}
    plain = [f"word card {right_card(r)} more" for _ in range(60)]
    found = spans_by_text(spark, [*texts, *plain])
    lost = [t for t in texts if not base(t)]  # digits beside a card make a right sum now and then
    right = sum(found[t] == f"card:{t.index(texts[t])}:{t.index(texts[t]) + 19}" for t in lost)
    assert len(lost) > 100 and right > 0.9 * len(lost)


def test_candidates_of_a_kind_overlap(spark):
    texts = ["4111 1111 1111 1111 123", "10.1.2.3.4", "bob [at] a [dot] b [dot] org", "tel 020 7946 0958 5"]
    rows = private._with_candidates(private._with_base(awkward(spark, texts).select("doc_id", "text"))).collect()
    proposed = {(r.doc_id, private.KINDS[c["kind"]], c["start"], c["end"]) for r in rows for c in r.candidates}
    assert {(0, "card", 0, 19), (0, "card", 0, 23), (0, "card", 5, 23)} <= proposed
    assert {(1, "ip", 0, 8), (1, "ip", 3, 10), (2, "email", 0, 18), (2, "email", 0, 28)} <= proposed
    assert {(3, "phone", 4, 19), (3, "phone", 8, 19)} <= proposed


def test_other_forms_do_not_count_as_errors(spark):
    """Most addresses in a form the base cannot read; the same at a tenth of the size."""
    r = random.Random(5)
    for n in (120, 12):
        mails = [f"mail {r.randrange(10**6)}x [at] site{i} [dot] org now" for i in range(n)]
        ips = [f"host {i % 200}[.]{r.randrange(256)}[.]7[.]{r.randrange(256)} up" for i in range(n)]
        phones = [f"call {r.randrange(200, 999)} 555-{r.randrange(1000, 9999)} now" for _ in range(n)]
        wrong = [f"host {r.randrange(256, 999)}[.]{r.randrange(256, 999)}[.]7[.]1 up" for _ in range(n // 40)]
        plain = [f"mail a{i}@b.org now" for i in range(n // 6)]
        found = spans_by_text(spark, [*mails, *ips, *phones, *wrong, *plain])
        for kind, texts in (("email", mails), ("ip", ips), ("phone", phones)):
            want = {t: f"{kind}:5:{len(t) - (3 if kind == 'ip' else 4)}" for t in texts}
            assert {t: found[t] for t in texts} == want, (n, kind)
        assert all(not found[t] for t in wrong)


def luhn_card(r):
    """Sixteen digits in groups of four with a right Luhn sum."""
    body = "4" + "".join(r.choice("0123456789") for _ in range(14))
    digits = next(body + d for d in "0123456789" if luhn(body + d))
    return " ".join(digits[i : i + 4] for i in range(0, 16, 4))


def planted(form, r):
    """(text around the span, span) in a form that the base patterns miss."""
    name, number = "".join(r.choices("abcdefgh", k=7)), lambda n: "".join(r.choices("123456789", k=n))
    return {
        "email": ("contact {} soon", f"{name}{number(2)} [at] {name[::-1]} [dot] org"),
        "phone": ("please call {} today", f"{number(3)} {number(3)} {number(4)}"),
        "phone wide": ("please call {} today", f"{number(3)}   {number(3)}   {number(4)}"),
        "ip": ("the host {} is up", "[.]".join(str(r.randint(1, 254)) for _ in range(4))),
        "card": ("paid by card {} " + number(3) + " then", luhn_card(r)),
    }[form]


def test_recall_of_added_spans(spark):
    """At least nine of ten planted spans of each form are found, beside other documents."""
    r = random.Random(21)
    forms = ("email", "phone", "phone wide", "ip", "card")
    filler = prose(4, 60 * len(forms), 20)
    texts, wanted = [], []
    for k, form in enumerate(form for form in forms for _ in range(60)):
        around, span = planted(form, r)
        text = " ".join(filler[k].split()) + " " + around.format(span)
        start = text.index(span)
        texts.append(text)
        wanted.append((form, f"{form.split()[0]}:{start}:{start + len(span)}"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [(-1 - k, text) for k, text in enumerate(texts)]
    found = private.private_spans(docs.union(spark.createDataFrame(rows, docs.schema)))
    spans = {row.doc_id: row.spans.split(",") for row in found.where("doc_id < 0").collect()}
    caught = {form: sum(s in spans[-1 - k] for k, (f, s) in enumerate(wanted) if f == form) for form in forms}
    assert min(caught.values()) >= 54, caught


def test_running_numbers_and_bisection(spark):
    r = random.Random(6)
    lists = [[], [0], [3, 1], *[[r.randrange(50) for _ in range(n)] for n in (5, 16, 17, 99, 1000)]]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(lists)], "k int, v array<int>")
    sums = private._running(F.col("v"), lambda a, b: a + b)
    tops = private._running(F.col("v"), lambda a, b: F.greatest(a, b))
    less = F.transform(F.sequence(F.lit(-1), F.lit(51)), lambda b: private._below(F.array_sort("v"), b))
    for k, s, t, n in df.select("k", sums, tops, less).collect():
        v = lists[k]
        assert s == [sum(v[: i + 1]) for i in range(len(v))] and t == [max(v[: i + 1]) for i in range(len(v))]
        assert n == [sum(x < b for x in v) for b in range(-1, 52)]


def test_touched_spans(spark):
    r = random.Random(8)

    def some(n):
        starts = [r.randrange(300) for _ in range(n)]
        return [(a, a + r.randint(1, 12)) for a in starts]

    rows = [(k, some(r.choice((0, 1, 3, 40))), some(50)) for k in range(40)]
    df = spark.createDataFrame(rows, "k int, base array<struct<start:int,end:int>>, asked array<struct<start:int,end:int>>")
    found = private._let(
        private._cover(F.col("base")), lambda cover: F.transform("asked", lambda c: private._touched(c, cover))
    )
    for k, got in df.select("k", found).collect():
        _, base_spans, asked = rows[k]
        assert got == [any(a < d and c < b for c, d in base_spans) for a, b in asked]


def test_many_separate_matches(spark):
    """Tens of thousands of matches of each kind, and of candidates beside them, in one text each."""
    n = 16_000
    texts = ["mail a@b.org now " * n, "é 10.1.2.3 up " * n, "pay 4111 1111 1111 1111 😀 " * (n // 4), "call 200 555-1234 now " * (n // 4)]
    found = private.private_spans(awkward(spark, [*texts, "mail x [at] b [dot] org now " * (n // 4)]))
    rows = {row.doc_id: row for row in found.collect()}
    for i, text in enumerate(texts):
        assert tuple(rows[i][c] for c in COLUMNS) == expected(i, text)
    assert rows[0].spans.count("email:") == n and rows[1].spans.count("ip:") == n
    assert rows[3].spans.split(",") == [f"phone:{22 * k + 5}:{22 * k + 17}" for k in range(n // 4)]
    assert rows[4].spans.split(",") == [f"email:{28 * k + 5}:{28 * k + 23}" for k in range(n // 4)]


def test_fit_on_drawn_texts(spark):
    """Copies count once, and a draw depends on the texts alone."""
    texts = [f"call {i} now" for i in range(2000)]
    docs = awkward(spark, [*texts, *[texts[0]] * 1000]).select("doc_id", "text")
    drawn = sorted(row.text for row in private._drawn(docs, 600).collect())
    assert len(set(drawn)) == len(drawn) and 300 < len(drawn) < 500
    assert drawn == sorted(row.text for row in private._drawn(docs.repartition(7), 600).collect())
    assert private._drawn(docs, 10**6).count() == 2000


def test_fit_on_all_texts(spark):
    """Every distinct text counts, however many there are, and copies count once."""
    n, rare = 60_000, 40
    calls = spark.range(n).select(F.concat(F.lit("call 20055"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("text"))
    docs = calls.union(calls.limit(500)).union(spark.range(rare).selectExpr("concat('no number ', id) AS text"))
    learnt = calls.filter(F.pmod(F.xxhash64("text"), F.lit(private.CALIBRATE)) != 0).count()
    trees, thresholds = private.fit_private(docs)
    # all candidates meet their check: the trees start at the logit of their smoothed share
    assert round((np.exp(trees.start) - 1) / 2) == learnt
    assert set(thresholds) == set(private.KINDS)
