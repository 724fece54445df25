r"""Personal data in texts: fixed patterns, and more spans from boosted trees over candidates.

Base spans are the leftmost non-overlapping matches per kind (``KINDS``) that pass the
kind's check: parts of an ip at most 255, a card with 16 to 19 digits and a right Luhn
sum, a phone with 8 to 15 digits. The expressions here are written so that Java's
matcher finds the same spans without going back: possessive repeats, and starts only
where a run of the first class starts or the match before ended (``\G``).

The method adds spans. Looser generators per kind propose candidates that overlap: every
range of digit groups with 13 to 19 digits in a run, every four parts of dotted or
bracketed numbers, every start of a phone number with or without a plus (as far as 15
digits go), and e-mail addresses with bracketed "at" and "dot" up to each of their labels.
A candidate is described by small numbers of its format (digits, separators) and context
(the characters beside it, a word of telling kind before it). Weak labels come from checks
that do not depend on the notation: a Luhn sum, octets, a last label of letters, a plus or
a telling word before a phone number. The trees do not see the Luhn sum nor the octets, so
their probability says how many candidates like this one meet the check. They are fitted
on the counts of the distinct descriptions of all candidates that a base span does not
partly cover, of whom there are few whatever the corpus, in all distinct texts. Three
quarters of the texts, by hash, teach the trees; the others calibrate them and set each
kind's threshold: the lowest at which those that meet the check do so, to ``PRECISION``,
not by chance. A candidate that meets its check, reaches
the threshold and does not touch a base span or a more probable candidate is a redaction
too. Limits: a phone number with neither plus nor telling word is not added; a candidate for
one ends with the last group that fits into 26 characters (``_PHONE_CHARS``), so one with wider
gaps is not proposed whole; of an e-mail's domain the first 127 labels count (``_LABELS``).

The work grows with a text's length and matches, but for a logarithm and a root: places are
running sums in blocks, a candidate finds the base spans it touches by bisection, and overlaps
are settled within each group of touching candidates.

Only DataFrame functions touch the texts, in two passes, to fit and to apply. The first
shuffles a hash and the descriptions of each text that has candidates, so that copies
count once; texts are not shuffled.

Defined cases: a null text is empty; a text without matches has the digest of an empty
list; repeated rows each get their result; without candidates nothing is added; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.rules import calibrated

KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # whole runs of 16 to 19 digits; other lengths fail the check anyway
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"(?:@|\x20?[\[({]\x20?(?:at|AT)\x20?[\])}]\x20?)"
_DOT = r"(?:\.|\x20?[\[({]\x20?(?:dot|DOT)\x20?[\])}]\x20?)"
_SEPARATOR = {
    "ip": r"(?:\.|\[\.\]|\(\.\)|[\[({]dot[\])}])",
    "card": r"[\x20./-]",
    "phone": r"[\x20()./-]{1,19}+",
}
#: Digit groups from which a piece of a run proposes, and those after it that candidates may reach into.
_GROUPS, _REACH = 16, 18


def _piece(kind: str, before: str, head: str, ahead: str) -> str:
    """Up to ``_GROUPS`` whole digit groups where ``ahead`` fits, and in group 1 the ``_REACH`` groups after them."""
    more = rf"(?:{_SEPARATOR[kind]}[0-9]++)"
    return rf"(?<![{before}]){head}(?={ahead})[0-9]++{more}{{0,{_GROUPS - 1}}}+(?=({more}{{0,{_REACH}}}+))"


#: E-mail addresses, and pieces of runs of digit groups; candidates are parts of these.
LOOSE = {
    "email": rf"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "ip": _piece("ip", "0-9A-Za-z", "", rf"[0-9]++(?:{_SEPARATOR['ip']}[0-9]++){{3}}"),
    "card": _piece("card", "0-9", "", rf"[0-9](?:{_SEPARATOR['card']}?+[0-9]){{12}}"),
    "phone": _piece("phone", "0-9A-Za-z+", r"\+?\(?", r"[0-9](?:[\x20()./-]{0,19}+[0-9]){6}"),
}
#: Digits of a candidate; an ip has four groups instead. Characters of a phone number at most.
_DIGITS = {"card": (13, 19), "phone": (7, 15)}
_PHONE_CHARS = 26
#: Labels of a domain name at most.
_LABELS = 127
#: What a text must contain for a kind to be looked for.
_NEEDS = {"email": r"@|[\[({]\x20?(?:at|AT)\x20?[\])}]", "ip": "[0-9]", "card": "[0-9]{2}|[0-9][ ./-]", "phone": "[0-9]"}
#: Words of telling kind before a candidate, first fitting group counts.
CONTEXT = (
    r"e-?mail|mailto|contact|write to",
    r"phone|tel\b|tel[.:]|call|fax|mobile|dial",
    r"card|visa|mastercard|credit|payment",
    r"\bip\b|host|server|address|gateway",
    r"order|invoice|ref\b|version|id\b|sha|key|token|isbn|password",
)
#: Words that make a number after them, without digits between, a phone number.
_TELLING = r"(?:phone|tel\b|tel[.:]|call|fax|mobile|dial)[^0-9]*$"
FEATURES = ("kind", "digits", "separators", "widest", "before", "after", "context")
CONTEXT_CHARS = 24
CALIBRATE = 4
PRECISION = 0.95
#: Share of other text that meets a kind's check by chance: a tenth of all numbers has a right Luhn sum.
CHANCE = {"email": 0.5, "ip": 0.5, "card": 0.1, "phone": 0.5}
#: Least threshold, and that of a kind without candidates to calibrate on.
FALLBACK = 0.5


#: Texts are cut into parts of 2 to this power code points, to look up characters at a place.
_PART_BITS = 9


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is worked out once, also where a lambda in ``use`` meets it many times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Each whole number from 0 on joined with those before it: running sums or maxima.

    A list that grows by one is copied each time, so lists grow only within blocks of about
    the root of the number of values.
    """

    def listed(numbers: Column) -> Column:
        def add(so_far: Column, v: Column) -> Column:
            before = F.coalesce(F.get(so_far, F.size(so_far) - 1), F.lit(0))
            return F.concat(so_far, F.array(join(before, v)))

        return F.aggregate(numbers, F.array().cast("array<int>"), add)

    def joined(x: Column) -> Column:
        def block(b: Column, k: Column) -> Column:
            return F.transform(b, lambda v: join(F.coalesce(F.get(x["upto"], k - 1), F.lit(0)), v))

        return F.flatten(F.transform(x["blocks"], block))

    def whole(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        firsts = F.sequence(F.lit(1), F.size(v), width)
        blocks = F.transform(firsts, lambda i: listed(F.slice(v, i, width)))
        upto = lambda b: listed(F.transform(b, lambda x: F.element_at(x, -1)))
        return _let(_let(blocks, lambda b: F.struct(b.alias("blocks"), upto(b).alias("upto"))), joined)

    return _let(values, lambda v: F.when(F.size(v) > 0, whole(v)).otherwise(F.array().cast("array<int>")))


def _below(ordered: Column, bound: Column) -> Column:
    """How many items of an ascending array are less than ``bound``, by bisection."""

    def halve(x: Column, _: Column) -> Column:
        middle = F.shiftright(x["low"] + x["high"], 1)
        less = F.get(ordered, middle) < bound
        nearer = F.when(less, F.struct((middle + 1).alias("low"), x["high"].alias("high"))).otherwise(
            F.struct(x["low"].alias("low"), middle.alias("high"))
        )
        return F.when(x["low"] >= x["high"], x).otherwise(nearer)

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(ordered) + 1)).cast("int"))
    begin = F.struct(F.lit(0).alias("low"), F.size(ordered).alias("high"))
    return F.aggregate(rounds, begin, halve, lambda x: x["low"])


def _with_matches(rows: DataFrame, patterns: dict[str, str], suffix: str, tails: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with a column per kind: all matches in ``text`` as structs (start, end, body, tail, backward).

    Places are code points; ``tail`` is group 1 for the kinds in ``tails``, else empty, and
    ``backward`` has the digits of the body from the last to the first. Matches and the gaps
    between them are columns of their own first, so that each expression is evaluated once
    per text.
    """
    columns = rows.columns
    text = F.col("text")
    lists = {}
    for kind in patterns:
        there = F.regexp_like(text, F.lit(_NEEDS[kind]))
        lists[f"_bodies_{kind}"] = F.when(there, F.regexp_extract_all(text, F.lit(patterns[kind]), F.lit(0)))
        if kind in tails:
            lists[f"_tails_{kind}"] = F.when(there, F.regexp_extract_all(text, F.lit(patterns[kind]), F.lit(1)))
    rows = rows.withColumns(lists)
    rows = rows.withColumns({f"_gaps_{k}": F.when(F.size(f"_bodies_{k}") > 0, F.split(text, p, -1)) for k, p in patterns.items()})
    none = F.array().cast("array<struct<start:int,end:int,body:string,tail:string,backward:string>>")

    def placed(kind: str, m: Column) -> Column:
        def span(end: Column, i: Column) -> Column:
            body = F.get(m["bodies"], i)
            return F.struct(
                (end - F.length(body)).alias("start"),
                end.alias("end"),
                body.alias("body"),
                (F.get(m["tails"], i) if kind in tails else F.lit("")).alias("tail"),
                F.reverse(F.regexp_replace(body, "[^0-9]", "")).alias("backward"),
            )

        steps = F.transform(m["bodies"], lambda b, i: F.length(b) + F.length(F.get(m["gaps"], i)))
        return F.transform(_running(steps, lambda a, b: a + b), span)

    def spans(kind: str) -> Column:
        lists = ("bodies", "gaps", "tails") if kind in tails else ("bodies", "gaps")
        given = F.struct(*[F.col(f"_{c}_{kind}").alias(c) for c in lists])
        some = F.size(f"_bodies_{kind}") > 0
        return F.when(some, _let(given, lambda m: placed(kind, m))).otherwise(none).alias(f"{kind}{suffix}")

    return rows.select(*columns, *[spans(k) for k in patterns])


def _luhn(backward: Column) -> Column:
    """Whether the Luhn sum of up to 19 digits, last first, is right."""
    total = F.lit(0)
    for i in range(19):
        d = F.greatest(F.ascii(F.substring(backward, i + 1, 1)) - 48, F.lit(0))
        total = total + (d if i % 2 == 0 else F.when(d > 4, 2 * d - 9).otherwise(2 * d))
    return total % 10 == 0


_OCTETS = r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$"


def _passes(kind: str, span: Column) -> Column:
    digits = F.length(span["backward"])
    if kind == "ip":
        return F.regexp_like(span["body"], F.lit(_OCTETS))
    if kind == "card":
        return digits.between(16, 19) & _luhn(span["backward"])
    return digits.between(8, 15) if kind == "phone" else F.lit(True)


def _with_base(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text) with the column base: structs (kind, start, end), by kind and place."""
    found = _with_matches(rows, BASE, "_base")

    def of(i: int) -> Column:
        kind = KINDS[i]
        right = F.filter(f"{kind}_base", lambda s: _passes(kind, s))
        return F.transform(
            right, lambda s: F.struct(F.lit(i).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
        )

    return found.select(*rows.columns, F.concat(*[of(i) for i in range(len(KINDS))]).alias("base"))


def _beside(char: Column) -> Column:
    return (
        F.when(char.isNull() | (char == "") | F.regexp_like(char, F.lit(r"\s")), 0)
        .when(F.regexp_like(char, F.lit(r"\p{L}")), 1)
        .when(F.regexp_like(char, F.lit("[0-9]")), 2)
        .otherwise(3)
    )


def _meets(kind: str, span: Column, after: Column) -> Column:
    """The weak label: a check that does not depend on how the candidate is written."""
    n = F.length(span["backward"])
    if kind == "email":
        return F.regexp_like(span["body"], F.lit(rf"{_DOT}(?:[A-Za-z]{{2,24}}|(?:xn|XN)--[A-Za-z0-9-]+)$"))
    if kind == "ip":
        plain = F.regexp_replace(span["body"], r"[\[({](?:\.|dot)[\])}]", ".")
        return F.regexp_like(plain, F.lit(_OCTETS)) & after.isin(0, 3)
    if kind == "card":
        return n.between(*_DIGITS["card"]) & _luhn(span["backward"])
    return n.between(8, 15) & (span["body"].startswith("+") | span["told"])


def _described(span: Column, kind: str) -> Column:
    """The span with its features, small whole numbers, and whether it meets its kind's check."""
    numeric = kind != "email"
    separators = F.length(F.regexp_replace(span["body"], r"[^ .()\[\]{}/-]", "")) if numeric else F.lit(0)
    after = _beside(span["next"])
    values = {
        "kind": F.lit(KINDS.index(kind)),
        "digits": F.least(F.length(span["backward"]), F.lit(20)) if numeric else F.lit(0),
        "separators": F.least(separators, F.lit(8)),
        "widest": span["widest"] if numeric else F.lit(0),
        "before": span["beside"],
        "after": after,
        "context": span["context"],
        "meets": _meets(kind, span, after),
    }
    return F.struct(span["start"].alias("start"), span["end"].alias("end"), *[v.cast("int").alias(f) for f, v in values.items()])


def _places(kind: str, m: Column) -> Column:
    """The groups of a piece, or the labels of an address: structs (n, first, last, upto).

    A candidate that starts with a group starts at its ``first``, one that ends with it ends
    before its ``last``; ``upto`` counts the digits of this group and those before it.
    """
    none = F.array().cast("array<struct<n:int,first:int,last:int,upto:int>>")

    def add(so_far: Column, i: Column) -> Column:
        unit, gap = F.element_at(m["units"], i), F.element_at(m["gaps"], i)
        first = so_far["at"] + F.length(gap)
        last = first + F.length(unit)
        if kind == "phone":
            first = first - F.length(F.regexp_extract(gap, r"\+?\(?$", 0))
        upto = so_far["upto"] + F.length(unit)
        place = F.struct(i.alias("n"), first.alias("first"), last.alias("last"), upto.alias("upto"))
        return F.struct(last.alias("at"), upto.alias("upto"), F.concat(so_far["list"], F.array(place)).alias("list"))

    begin = F.struct(F.lit(0).alias("at"), F.lit(0).alias("upto"), none.alias("list"))
    return F.aggregate(F.sequence(F.lit(1), F.size(m["units"])), begin, add, lambda x: x["list"])


def _starts(kind: str, m: Column) -> Column:
    """Where candidates of a piece start, with all that depends on the start alone."""

    def context(before: Column) -> Column:
        value = F.lit(len(CONTEXT))
        for i in range(len(CONTEXT) - 1, -1, -1):
            value = F.when(F.regexp_like(before, F.lit(CONTEXT[i])), i).otherwise(value)
        return value

    def cut(x: Column) -> Column:
        first = F.lit(0) if kind == "email" else x["first"]
        at = m["lead"] + first
        many = F.least(at, F.lit(CONTEXT_CHARS))
        reach = F.slice(m["places"], 2, _LABELS) if kind == "email" else F.slice(m["places"], x["n"], _REACH + 1)
        return F.struct(
            x["n"].alias("n"),
            first.alias("first"),
            at.alias("at"),
            (x["upto"] - F.length(F.element_at(m["units"], x["n"]))).alias("upto"),
            reach.alias("reach"),
            F.lower(F.substring(m["near"], at - many + 1, many)).alias("words"),
            F.substring(m["near"], at, F.when(at > 0, 1).otherwise(0)).alias("beside"),
        )

    def described(x: Column) -> Column:
        told = F.regexp_like(x["words"], F.lit(_TELLING)) if kind == "phone" else F.lit(False)
        return F.struct(
            *[x[f].alias(f) for f in ("first", "at")],
            _fitting(kind, x).alias("ends"),
            context(x["words"]).alias("context"),
            told.alias("told"),
            _beside(x["beside"]).alias("beside"),
        )

    own = F.transform(F.slice(m["places"], 1, m["own"]), cut)
    return F.filter(F.transform(own, described), lambda x: F.size(x["ends"]) > 0)


def _fitting(kind: str, start: Column) -> Column:
    """The ends of the candidates of a start; a phone number goes on as far as it can."""

    def fits(x: Column) -> Column:
        if kind == "email":
            return F.lit(True)
        if kind == "ip":
            return x["n"] - start["n"] == 3
        right = (x["upto"] - start["upto"]).between(*_DIGITS[kind])
        return right & (x["last"] - start["first"] <= _PHONE_CHARS) if kind == "phone" else right

    ends = F.transform(F.filter(start["reach"], fits), lambda x: x["last"])
    return F.slice(F.reverse(ends), 1, 1) if kind == "phone" else ends


def _with_candidates(rows: DataFrame) -> DataFrame:
    """``rows`` with the column candidates: structs (start, end, features, meets) of all generators.

    A piece is cut out of the text with its surroundings once, so that its candidates cost
    the same wherever it stands.
    """
    numeric = [k for k in KINDS if k != "email"]
    found = _with_matches(rows, LOOSE, "_loose", tuple(numeric))
    some = sum((F.size(f"{k}_loose") for k in KINDS), F.lit(0)) > 0
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{1 << _PART_BITS}}}+"), F.lit(0))
    found = found.withColumn("_parts", F.when(some, cut))
    parts = F.col("_parts")

    def before(place: Column, many: Column) -> Column:
        """The characters up to a place; the text is not gone through from its start for them."""
        k = F.shiftright(place, _PART_BITS)
        near = F.concat(F.coalesce(F.get(parts, k - 1), F.lit("")), F.coalesce(F.get(parts, k), F.lit("")))
        inside = place - F.shiftleft(F.greatest(k - 1, F.lit(0)), _PART_BITS)
        return F.substring(near, inside - many + 1, many)

    def at(place: Column) -> Column:
        inside = place.bitwiseAND(F.lit((1 << _PART_BITS) - 1))
        return F.coalesce(F.substring(F.get(parts, F.shiftright(place, _PART_BITS)), inside + 1, F.lit(1)), F.lit(""))

    def of(kind: str) -> Column:
        def piece(s: Column) -> Column:
            whole = F.concat(s["body"], s["tail"])
            lead = F.least(s["start"], F.lit(CONTEXT_CHARS))
            if kind == "email":
                head = F.regexp_extract(whole, rf"^[A-Za-z0-9._%+-]++{_AT}", 0)
                host = F.substring(whole, F.length(head) + 1, F.length(whole))
                units = F.slice(F.split(host, _DOT, -1), 1, _LABELS)
                gaps = F.concat(F.array(head), F.regexp_extract_all(host, F.lit(_DOT), F.lit(0)))
                own = F.lit(1)
            else:
                units, gaps = F.regexp_extract_all(whole, F.lit("[0-9]++"), F.lit(0)), F.split(whole, "[0-9]++", -1)
                own = F.size(F.regexp_extract_all(s["body"], F.lit("[0-9]++"), F.lit(0)))
            near = F.concat(before(s["start"], lead), whole, at(s["start"] + F.length(whole)))
            return F.struct(
                s["start"].alias("start"), lead.alias("lead"), near.alias("near"),
                units.alias("units"), gaps.alias("gaps"), own.alias("own"),
            )

        def spans(m: Column) -> Column:
            def of_start(x: Column) -> Column:
                def span(end: Column) -> Column:
                    body = F.substring(m["near"], x["at"] + 1, end - x["first"])
                    return F.struct(
                        (m["start"] + x["first"]).alias("start"),
                        (m["start"] + end).alias("end"),
                        body.alias("body"),
                        F.substring(m["near"], m["lead"] + end + 1, F.lit(1)).alias("next"),
                        (end == F.element_at(x["ends"], -1)).alias("widest"),
                        F.reverse(F.regexp_replace(body, "[^0-9]", "")).alias("backward"),
                        *[x[f].alias(f) for f in ("context", "told", "beside")],
                    )

                return F.transform(F.transform(x["ends"], span), lambda c: _described(c, kind))

            return F.flatten(F.transform(_starts(kind, m), of_start))

        pieces = F.transform(F.transform(f"{kind}_loose", piece), lambda m: m.withField("places", _places(kind, m)))
        return F.flatten(F.transform(pieces, spans))

    return found.select(*rows.columns, F.concat(*[of(k) for k in KINDS]).alias("candidates"))


@dataclass
class BoostedTrees:
    """Sums of small trees over whole-number features; a tree is nested (feature, cut, left, right) or a value."""

    start: float
    trees: list
    slope: float = 1.0
    offset: float = 0.0

    def value(self, x: np.ndarray) -> np.ndarray:
        def of(tree, rows: np.ndarray) -> np.ndarray:
            if isinstance(tree, float):
                return np.full(len(rows), tree)
            j, cut, left, right = tree
            return np.where(rows[:, j] <= cut, of(left, rows), of(right, rows))

        return self.start + sum((of(t, x) for t in self.trees), np.zeros(len(x)))

    def probability(self, features: list[Column]) -> Column:
        """The calibrated probability as a native expression."""

        def of(tree) -> Column:
            if isinstance(tree, float):
                return F.lit(tree)
            j, cut, left, right = tree
            return F.when(features[j] <= cut, of(left)).otherwise(of(right))

        total = F.lit(self.start)
        for tree in self.trees:
            total = total + of(tree)
        return 1 / (1 + F.exp(-(self.slope * total + self.offset)))

    @classmethod
    def fit(cls, x: np.ndarray, up: np.ndarray, n: np.ndarray, rounds: int = 20, depth: int = 3, rate: float = 0.3) -> BoostedTrees:
        """Rows of ``x`` stand for ``n`` candidates, ``up`` of them with label 1 (logistic loss)."""
        model = cls(float(np.log((up.sum() + 0.5) / (n.sum() - up.sum() + 0.5))), [])
        total = np.full(len(x), model.start)

        def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, levels: int):
            value = rate * g[rows].sum() / (h[rows].sum() + 1.0)
            best = (1e-6, None, None)
            for j in range(x.shape[1]) if levels else ():
                for cut in np.unique(x[rows, j])[:-1]:
                    left = rows[x[rows, j] <= cut]
                    gl, hl = g[left].sum(), h[left].sum()
                    gr, hr = g[rows].sum() - gl, h[rows].sum() - hl
                    gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - (gl + gr) ** 2 / (hl + hr + 1)
                    if gain > best[0]:
                        best = (gain, j, int(cut))
            if best[1] is None:
                return float(value)
            _, j, cut = best
            left = x[rows, j] <= cut
            return j, cut, grow(rows[left], g, h, levels - 1), grow(rows[~left], g, h, levels - 1)

        for _ in range(rounds):
            p = 1 / (1 + np.exp(-total))
            tree = grow(np.arange(len(x)), up - n * p, n * p * (1 - p), depth)
            model.trees.append(tree)
            total += cls(0.0, [tree]).value(x)
        return model


def _drawn(docs: DataFrame, texts: int) -> DataFrame:
    """About ``texts`` distinct texts, or all there are, drawn by their hash; copies count once."""
    share = min(1.0, texts / max(docs.count(), 1))
    mark = F.pmod(F.xxhash64("text", F.lit("draw")), F.lit(1 << 30))
    return docs.select("text").filter(mark < int(share * (1 << 30))).distinct()


def fit_private(docs: DataFrame, texts: int | None = None) -> tuple[BoostedTrees, dict[str, float]] | None:
    """The trees and the kinds' thresholds; None if there is not one candidate.

    They are fitted on all distinct texts, or if ``texts`` is given on about so many.
    """
    if texts is not None:
        docs = _drawn(docs, texts)
    part = (F.pmod(F.xxhash64("text"), F.lit(CALIBRATE)) == 0).cast("int")
    rows = docs.select("text", F.sha2("text", 256).alias("key"), part.alias("part"))

    def is_base(c: Column, base: Column) -> Column:
        same = F.struct(*[c[f].alias(f) for f in ("kind", "start", "end")])
        return F.coalesce(F.get(base, _below(base, same)) == same, F.lit(False))

    # parts of base spans are neither right nor wrong: they are never asked about
    def labelled(x: Column) -> Column:
        sure = F.transform("candidates", lambda c: c.withField("sure", is_base(c, x["base"])))
        asked = F.filter(sure, lambda c: c["sure"] | ~_touched(c, x["cover"]))
        label = lambda c: F.greatest(c["meets"], c["sure"].cast("int")).alias("label")
        return F.transform(asked, lambda c: F.struct(*[c[f].alias(f) for f in FEATURES], label(c)))

    spans = _let(F.struct(F.array_sort("base").alias("base"), _cover(F.col("base")).alias("cover")), labelled)
    some = F.filter(F.array(spans), lambda s: F.size(s) > 0)  # no row for a text without candidates
    rows = (
        _with_candidates(_with_base(rows))
        .select("key", "part", F.explode(some).alias("spans"))
        .distinct()
        .select("part", F.explode("spans").alias("c"))
        .groupBy("part", *[F.col("c")[f].alias(f) for f in FEATURES])
        .agg(F.count(F.lit(1)).alias("n"), F.sum("c.label").alias("up"))
        .collect()  # distinct descriptions: bounded by the features' ranges
    )
    if not rows:
        return None
    rows = sorted(tuple(r) for r in rows)
    table = np.array(rows, float).reshape(len(rows), len(FEATURES) + 3)
    learnt, held = table[table[:, 0] == 0], table[table[:, 0] == 1]
    trees = BoostedTrees.fit(learnt[:, 1:-2], learnt[:, -1], learnt[:, -2])
    hx, hn, hup = held[:, 1:-2], held[:, -2], held[:, -1]
    z = trees.value(hx)
    if 0 < hup.sum() < hn.sum() and z.std() > 0:
        trees.slope, trees.offset = calibrated(np.repeat(z, 2), np.tile([1.0, 0.0], len(z)), np.stack([hup, hn - hup], 1).ravel())
    p = 1 / (1 + np.exp(-(trees.slope * z + trees.offset)))
    return trees, {kind: _threshold(kind, *(v[hx[:, 0] == i] for v in (p, hn, hup))) for i, kind in enumerate(KINDS)}


def _threshold(kind: str, p: np.ndarray, n: np.ndarray, up: np.ndarray) -> float:
    """The lowest probability from which on the candidates that meet the check are right to ``PRECISION``.

    Those that fail it tell how many meet it by chance. The counts are smoothed by candidates
    that are right to exactly ``PRECISION``, whose number then does not matter: ten and ten
    million candidates of the same shares have the same threshold. Without a candidate it is
    ``FALLBACK``; if no probability will do, the one at which ``PRECISION`` is expected.
    """
    if not len(p):
        return FALLBACK
    chance = CHANCE[kind]
    order = np.argsort(-p, kind="stable")
    ps, passed, failed = p[order], up[order].cumsum(), (n - up)[order].cumsum()
    last = np.append(ps[1:] != ps[:-1], True)
    wrong = failed * chance / (1 - chance)
    good = np.flatnonzero((wrong <= (1 - PRECISION) * passed) & (passed > 0) & last)
    return max(FALLBACK, float(ps[good[-1]])) if len(good) else chance / (1 - PRECISION * (1 - chance))


def _touches(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _cover(spans: Column) -> Column:
    """The spans' starts in order, and as far as the spans up to each start reach."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    def cover(s: Column) -> Column:
        reach = _running(F.transform(s, lambda x: x["end"]), lambda a, b: F.greatest(a, b))
        return F.struct(F.transform(s, lambda x: x["start"]).alias("starts"), reach.alias("reach"))

    return _let(ordered, cover)


def _touched(c: Column, cover: Column) -> Column:
    """Whether the span touches any of those of a cover."""
    return F.coalesce(F.get(cover["reach"], _below(cover["starts"], c["end"]) - 1) > c["start"], F.lit(False))


def _added(model: tuple[BoostedTrees, dict[str, float]] | None) -> Column:
    """Structs (kind, start, end) of the candidates that are redactions, beside the column base."""
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    if not model or not model[1]:
        return none
    trees, thresholds = model

    def enough(c: Column) -> Column:
        bound = F.lit(2.0)
        for kind, value in thresholds.items():
            bound = F.when(c["kind"] == KINDS.index(kind), value * (1 - 1e-12)).otherwise(bound)
        return c["p"] >= bound

    def scored(cover: Column) -> Column:
        right = F.filter("candidates", lambda c: (c["meets"] == 1) & ~_touched(c, cover))
        return F.transform(right, lambda c: c.withField("p", trees.probability([c[f] for f in FEATURES])))

    # the most probable first, to a twentieth; of equals the one that starts first, then the longer, then the earlier kind
    def ranked(c: Column) -> Column:
        return F.struct(F.round(-20 * c["p"]).alias("q"), c["start"].alias("start"), (-c["end"]).alias("back"), c["kind"].alias("kind"))

    def take(kept: Column, c: Column) -> Column:
        c = c.withField("end", -c["back"])
        span = F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
        return F.when(F.exists(kept, lambda k: _touches(k, c)), kept).otherwise(F.concat(kept, F.array(span)))

    def chosen(x: Column) -> Column:
        """The choice within each group: it begins where no span before reaches."""
        n, spans, reach = F.size(x["spans"]), x["spans"], x["cover"]["reach"]
        firsts = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.coalesce(F.get(reach, i - 1) <= F.get(spans, i)["start"], F.lit(True)),
        )

        def group(first: Column, upto: Column) -> Column:
            own = F.transform(F.sequence(first, upto), lambda i: ranked(F.get(spans, i)))
            return F.aggregate(F.array_sort(own), none, take)

        def groups(f: Column) -> Column:
            return F.transform(f, lambda i, k: group(i, F.coalesce(F.get(f, k + 1), n) - 1))

        return F.flatten(_let(firsts, groups))

    def placed(free: Column) -> Column:
        ordered = F.array_sort(F.transform(free, lambda c: F.struct(*[c[f].alias(f) for f in ("start", "end", "kind", "p")])))
        both = _let(ordered, lambda s: F.struct(s.alias("spans"), _cover(s).alias("cover")))
        return F.when(F.size(free) > 0, _let(both, chosen)).otherwise(none)

    return _let(F.filter(_let(_cover(F.col("base")), scored), enough), placed)


def _listed(spans: Column) -> Column:
    """Spans as text, by kind and then place."""
    name = F.array(*[F.lit(k) for k in KINDS])
    texts = F.transform(
        F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(texts, ",")


def private_spans(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    model = fit_private(rows)
    found = _with_base(rows)
    if model and model[1]:
        found = _with_candidates(found)
    found = found.select("doc_id", "base", _added(model).alias("added"))

    def number_of(i: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")

    return found.select(
        "doc_id",
        *[number_of(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"),
    )
