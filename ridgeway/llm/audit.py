"""What each filter removes in every order of filters, from one pass over the documents.

A document's failures are a mask of one bit per filter, so a part (a source) is a function from
masks to counts. :class:`Diagram` keeps it as a decision diagram with one level per filter:
equal subfunctions of a level are one node, and each node knows the counts below it. Along the
path on which all filters pass, a level's failing branch is what its filter removes. Two
neighbouring levels are swapped by regrouping the four grandchildren of each node, which touches
no other level; a walk of such swaps meets every order once.

Spark does what grows with the rows: masks are native expressions on whole texts, equal texts
are found by their digests, counts per part and mask are added up before they are shuffled. A
part's diagram has at most 2^filters leaves, whatever its rows, so a part with a third of all
rows costs no more than another. A copy of an earlier text is found by joining digest *and* id
to the least id of each digest: no group of copies meets in one task.

Defined cases: a null text is empty; a null part is the empty string; a null id is neither
smaller than another nor has it a smaller one; repeated rows with one id are all originals or
all copies; of several labels of an id the greatest counts, null counts as 0; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


FILTERS = "ABCDE"
WORD_BREAKS = "[\\x20\\x09-\\x0D]+"
#: Counts that are carried: all documents, good ones, toxic ones.
WEIGHTS = ("n", "good", "toxic")


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text; words are runs without ASCII white space."""
    words = F.filter(F.split(text, WORD_BREAKS), lambda w: w != "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n_words < 200,
        "B": F.lit(100) * n_distinct < F.lit(50) * n_words,
        "C": F.lit(100) * capitals > F.lit(2) * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_masks(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "source") -> DataFrame:
    """(doc_id, part, mask) of every row: bit i is set where it fails filter i of ``FILTERS``."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    slim = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole.alias("text")
    )
    bits = [failed.cast("int") * (1 << i) for i, failed in enumerate(text_failures(F.col("text")).values())]
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    rows = slim.select("doc_id", "part", sum(bits[1:], bits[0]).alias("mask"), digest.alias("digest"))
    # every copy but those with the least id fails; the join's key is all but unique
    first = slim.where("doc_id is not null").groupBy(digest.alias("digest")).agg(F.min("doc_id").alias("doc_id"))
    first = first.withColumn("original", F.lit(True))
    found = rows.join(first, ["digest", "doc_id"], "left")
    copied = F.col("original").isNull() & F.col("doc_id").isNotNull()
    return found.select("doc_id", "part", (F.col("mask") + copied.cast("int") * 16).alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, those of label quality 1, those of label toxic 1."""
    known = (
        labels.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(*(F.max((F.coalesce(F.col(c), F.lit(0)) == 1).cast("long")).alias(w) for c, w in (("quality", "good"), ("toxic", "toxic"))))
    )
    rows = masks.join(known, "doc_id", "left")
    sums = [F.sum(F.coalesce(F.col(w), F.lit(0))).alias(w) for w in WEIGHTS[1:]]
    return rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), *sums)


class Diagram:
    """Counts over masks as levels of shared nodes; ``order`` names the filter of each level."""

    def __init__(self, leaves: np.ndarray):
        """``leaves[mask]`` holds the counts of a mask; the first filter is the lowest bit."""
        size = len(leaves).bit_length() - 1
        self.order = list(range(size))
        self.value: list[tuple[int, ...]] = []  # counts below each node
        self._leaf: dict[tuple[int, ...], int] = {}
        self.children: dict[int, tuple[int, int]] = {}
        self._unique: list[dict[tuple[int, int], int]] = [{} for _ in range(size)]

        def build(level: int, mask: int) -> int:
            if level == size:
                return self._terminal(tuple(int(x) for x in leaves[mask]))
            return self._node(level, build(level + 1, mask), build(level + 1, mask | 1 << level))

        self.root = build(0, 0)

    def _terminal(self, counts: tuple[int, ...]) -> int:
        if counts not in self._leaf:
            self._leaf[counts] = len(self.value)
            self.value.append(counts)
        return self._leaf[counts]

    def _node(self, level: int, passing: int, failing: int) -> int:
        key = (passing, failing)
        found = self._unique[level].get(key)
        if found is None:
            found = self._unique[level][key] = len(self.value)
            self.children[found] = key
            self.value.append(tuple(a + b for a, b in zip(self.value[passing], self.value[failing])))
        return found

    def nodes(self, level: int) -> int:
        return len(self._unique[level])

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and ``level + 1``; each upper node keeps its function."""
        upper = self._unique[level]
        self._unique[level], self._unique[level + 1] = {}, {}
        for (low, high), node in upper.items():
            (a, b), (c, d) = self.children[low], self.children[high]
            key = self._node(level + 1, a, c), self._node(level + 1, b, d)
            self.children[node] = key
            self._unique[level][key] = node
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def path(self) -> list[tuple[int, int]]:
        """(node after passing, node after failing) of each level, along the path that passes all."""
        steps, node = [], self.root
        for _ in self.order:
            steps.append(self.children[node])
            node = steps[-1][0]
        return steps

    def last_failing_alone(self) -> int:
        """The leaf that fails the last level's filter and no other."""
        return self.path()[-1][1]


def adjacent_swaps(size: int) -> Iterator[int]:
    """Levels to swap with the next one so that every order of ``size`` is met once (plain changes)."""
    if size < 2:
        return
    inner = adjacent_swaps(size - 1)
    down = True
    for _ in range(factorial(size - 1)):
        yield from range(size - 2, -1, -1) if down else range(size - 1)
        step = next(inner, None)
        if step is not None:
            yield step + down
        down = not down


def audit_steps(leaves: np.ndarray, names: str = FILTERS) -> pd.DataFrame:
    """All orders and steps of one part from its counts per mask."""
    diagram = Diagram(leaves)
    size = len(names)
    failing: dict[int, int] = {}  # all that fail a filter, known where it is first
    alone: dict[int, int] = {}  # what fails a filter only, known where it is last
    shapley = [0] * size
    steps = []

    def visit() -> None:
        order = "".join(names[f] for f in diagram.order)
        path = diagram.path()
        failing.setdefault(diagram.order[0], diagram.value[path[0][1]][0])
        alone.setdefault(diagram.order[-1], diagram.value[diagram.last_failing_alone()][0])
        for step, (f, (kept, gone)) in enumerate(zip(diagram.order, path), 1):
            n, good, toxic = diagram.value[gone]
            shapley[f] += n
            steps.append((order, step, f, diagram.value[kept][0], n, good, toxic))

    visit()
    for level in adjacent_swaps(size):
        diagram.swap(level)
        visit()
    out = pd.DataFrame(steps, columns=["filter_order", "step", "f", "kept", "removed", "good_lost", "toxic_lost"])
    out["redundant"] = out["f"].map(failing) - out["removed"]
    out["unique_fails"] = out["f"].map(alone)
    out["shapley"] = out["f"].map(dict(enumerate(shapley)))
    return out.drop(columns="f")


AUDIT_COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """A row per part, order of the five filters and step; see the module's text."""
    counts = mask_counts(failure_masks(docs, part=part), labels)
    row = F.struct("mask", *WEIGHTS)
    parts = counts.groupBy("part").agg(F.collect_list(row).alias("rows"))  # at most 32 rows a part

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, rows in zip(frame["part"], frame["rows"]):
                leaves = np.zeros((1 << len(FILTERS), len(WEIGHTS)), np.int64)
                for r in rows:
                    leaves[r["mask"]] = [r[w] for w in WEIGHTS]
                yield audit_steps(leaves).assign(part=name)

    numbers = ", ".join(f"{c} long" for c in AUDIT_COLUMNS)
    return parts.mapInPandas(run, f"part string, filter_order string, step int, {numbers}")
