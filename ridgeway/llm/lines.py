"""Later copies of repeated runs of lines, found by a suffix array over line ids.

A line (text between line feeds, exactly as it stands) is deleted if it lies in a run of
lines that has at least ``min_words`` words and also occurs earlier: in a document of
smaller id, or further up in the same one. Runs lie within one document and may overlap
their copy. The first occurrence of every line always stays, so nothing is lost.

Method: every document is a sequence of line ids, closed by its end. Ranks of its
suffixes are doubled: the ranks by 2k lines are the order of the pairs (rank by k lines
here, rank by k lines k lines on). Only suffixes whose first k lines occur more than
once go on, since the others already have a place of their own. The order of the
distinct pairs comes from a range-partitioned sort, and positions get their rank by a
join, so a pair in a third of all documents is one row to the sort and a skewed join,
which the adaptive planner splits. The suffixes that share their first l lines are an
interval of the suffix array with longest common prefixes of at least l; it is named by
the ranks of the two blocks of 2^j lines that cover the l lines from both ends. For each
position the intervals looked at are the shortest runs from it, and up to it, that reach
``min_words`` words: every longer maximal run is the union of such runs. In each
interval the first occurrence stays, and the lines of the others are deleted.

Defined cases: a null text stays null and has no lines; an empty text is one empty line
and stays; a text whose lines are all deleted becomes empty; rows equal in doc_id and
text count as one document and all get its result; null ids come last in the order, and
different texts of one id are ordered by their hash; an empty table gives an empty
result. ``dedup_lines`` passes other columns on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeway.llm.common import bounded_slices, fresh, staged

MIN_WORDS = 50


def _place(doc_id: str, text: str) -> Column:
    """What stands for a document: orders by id, nulls last, then by the text's hash."""
    return F.struct(
        F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("hash")
    )


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A row per line: place, line, 128-bit id (two longs), words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded_slices(batches):
            owner, number, ids, words = [], [], [], []
            for i, body in enumerate(part.column(1).to_pylist()):
                lines = body.encode().split(b"\n")
                owner += [i] * len(lines)
                number += range(len(lines))
                ids += [xxhash.xxh3_128_digest(line) for line in lines]
                words += [len(line.split()) for line in lines]
            halves = np.frombuffer(b"".join(ids), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(owner, pa.int64())),
                    pa.array(number, pa.int32()),
                    *(pa.array(np.ascontiguousarray(halves[:, k])) for k in (0, 1)),
                    pa.array(words, pa.int64()),
                ],
                ["place", "line", "high", "low", "words"],
            )

    rows = docs.where(F.col(text).isNotNull()).select(
        _place(doc_id, text).alias("place"), F.col(text).cast("string").alias("text")
    )
    kind = rows.schema["place"].dataType.simpleString()
    return rows.mapInArrow(run, f"place {kind}, line int, high long, low long, words long")


def _ranked(distinct: DataFrame, *columns: str) -> DataFrame:
    """Distinct rows with the column rank: numbers that grow in the order of ``columns``."""
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = distinct.repartitionByRange(parts, *columns).sortWithinPartitions(*columns)
    return staged(ordered.select(*columns, F.monotonically_increasing_id().alias("rank")), "ranks")


def _shortest_runs(active: DataFrame, min_words: int) -> DataFrame:
    """(place, first, length) of the shortest runs of repeated lines from and up to each line with ``min_words``."""
    by_document = (
        active.groupBy("place")
        .agg(F.sort_array(F.collect_list(F.struct("line", "words"))).alias("lines"), F.sum("words").alias("all"))
        .where(F.col("all") >= min_words)
        .select("place", "lines.line", "lines.words")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            line, words = (batch.column(c).flatten().to_numpy() for c in ("line", "words"))
            owner = np.repeat(np.arange(batch.num_rows), batch.column("line").value_lengths().to_numpy())
            stretch = np.cumsum((np.diff(owner, prepend=-1) != 0) | (np.diff(line, prepend=-2) != 1))
            total = np.concatenate([[0], np.cumsum(words)])
            at = np.arange(len(line))
            # from each line to the first end that reaches the words, and from the last start to each line
            last = np.searchsorted(total, total[:-1] + min_words) - 1
            first = np.searchsorted(total, total[1:] - min_words, "right") - 1
            runs = []
            for a, b in ((at, last), (first, at)):
                fits = (a >= 0) & (b < len(line))
                a, b = a[fits], b[fits]
                same = stretch[a] == stretch[b]
                runs.append(np.stack([a[same], b[same]], axis=1))
            a, b = np.unique(np.concatenate(runs), axis=0).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("place").take(pa.array(owner[a])), pa.array(line[a]), pa.array((b - a + 1).astype(np.int32))],
                ["place", "first", "length"],
            )

    kind = active.schema["place"].dataType.simpleString()
    return by_document.mapInArrow(run, f"place {kind}, first int, length int")


def _doubled(ranks: DataFrame, half: int, wanted: DataFrame) -> DataFrame:
    """Ranks by twice ``half`` lines of the positions whose lines occur more than once, in ``wanted`` documents."""
    here = ranks.join(wanted, "place", "left_semi")
    ahead = here.select("place", (F.col("line") - half).alias("line"), F.col("rank").alias("next"))
    pairs = staged(here.withColumnRenamed("rank", "this").join(ahead, ["place", "line"]), "pairs")
    repeated = pairs.groupBy("this", "next").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("this", "next")
    ranked = _ranked(repeated, "this", "next")
    return staged(pairs.join(ranked, ["this", "next"]).select("place", "line", "rank"), "suffixes")


def later_copies(
    docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(place, first, length) of runs of lines to delete; ``place`` is ``_place`` of the document."""
    if min_words < 1:
        raise ValueError("min_words must be at least 1")
    lines = staged(_lines(docs, doc_id, text), "lines")
    repeated = lines.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("high", "low")
    active = lines.join(_ranked(repeated, "high", "low"), ["high", "low"])
    # rows equal in id and text are one document
    active = staged(active.select("place", "line", "words", "rank").distinct(), "active")
    runs = staged(_shortest_runs(active, min_words), "runs")
    longest = runs.agg(F.max("length")).first()[0] or 0
    ranks, size, copies = active.select("place", "line", "rank"), 1, []
    while size <= longest:
        if size > 1:
            wanted = runs.where(F.col("length") >= size).select("place").distinct()
            ranks = _doubled(ranks, size // 2, wanted)
        head = ranks.select("place", F.col("line").alias("first"), F.col("rank").alias("head"))
        tail = ranks.select("place", F.col("line").alias("second"), F.col("rank").alias("tail"))
        level = runs.where(F.col("length").between(size, 2 * size - 1))
        named = (
            level.withColumn("second", F.col("first") + F.col("length") - size)
            .join(head, ["place", "first"])
            .join(tail, ["place", "second"])
            .select("place", "first", "length", "head", "tail")
        )
        named = staged(named, "intervals")
        interval = ["length", "head", "tail"]
        kept = named.groupBy(*interval).agg(
            F.min(F.struct("place", "first")).alias("kept"), F.count(F.lit(1)).alias("n")
        ).where("n > 1").drop("n")
        kept = staged(kept, "kept")  # two plain inputs for the join: Spark can split a frequent run's
        later = named.join(kept, interval).where(F.struct("place", "first") != F.col("kept"))
        copies.append(later.select("place", "first", "length"))
        size *= 2
    if not copies:
        return runs
    found = copies[0]
    for more in copies[1:]:
        found = found.unionByName(more)
    return found


def dedup_lines(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
    counts: tuple[str, str] | None = None,
) -> DataFrame:
    """``docs`` with later copies cut from ``text``; ``counts`` names columns for all and for deleted lines."""
    copies = later_copies(docs, min_words, doc_id, text)
    names = docs.columns
    place, cuts = fresh(docs, "place"), fresh(docs, "cuts")
    by_document = copies.groupBy(F.col("place").alias(place)).agg(F.collect_set(F.struct("first", "length")).alias(cuts))
    joined = docs.withColumn(place, _place(doc_id, text)).join(by_document, place, "left").drop(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded_slices(batches, text):
            at = part.schema.get_field_index(text)
            texts = part.column(at).to_pylist()
            total, deleted = [0] * len(texts), [0] * len(texts)
            for i, ranges in enumerate(part.column(cuts).to_pylist()):
                if texts[i] is None:
                    continue
                total[i] = texts[i].count("\n") + 1
                if ranges:
                    lines = np.array(texts[i].split("\n"), object)
                    keep = np.ones(len(lines), bool)
                    for r in ranges:
                        keep[r["first"] : r["first"] + r["length"]] = False
                    texts[i] = "\n".join(lines[keep])
                    deleted[i] = int((~keep).sum())
            columns = [pa.array(texts, pa.string()) if k == at else part.column(k) for k in range(len(names))]
            if counts:
                columns += [pa.array(total, pa.int64()), pa.array(deleted, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, *(counts or ())])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in counts or ())])
    schema[text].dataType = T.StringType()
    return joined.mapInArrow(run, schema)
