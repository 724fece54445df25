"""Words of documents that also stand in benchmark items, found by winnowing.

A window is ``window`` consecutive words of an item, or all words of a shorter item.
A document word is hit if it lies in any occurrence of a window. Words are runs of
ASCII letters and digits (A-Z lower-cased) and of all characters beyond ASCII.

Method: spans of L words must be found (L is ``window``, or the length of shorter
items). Of every L - k + 1 consecutive k-grams (k about half of L) the one of least
hash is kept, the rightmost of equals, on both sides. A shared span of L words shows
the same k-grams to both, so at least one common k-gram is kept there: none is missed.
Kept k-grams are joined on their hash, and each hit is extended word by word in both
directions, as strings, as far as a window through it can reach. Hits whose extended
run reaches L words count.

What is broadcast has a fixed size: a bit table of ``FILTER_BITS`` bits that says
which hashes the benchmark can have. It only spares the join rows without a partner.
One row per document carries its kept k-grams, so a passage in a third of all
documents is an ordinary skewed equi-join, which the adaptive planner splits.

Defined cases: null and empty texts have no words, no hits, and the digest of an
empty list; items without words have no window; an item without an id hits words but
isn't counted; repeated items count once; every row of a repeated document gets its
own result; an empty benchmark hits nothing; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridgeway.llm import wordhash
from ridgeway.llm.common import bounded_slices, fresh, raw_bytes, staged

FILTER_BITS = 1 << 25
HIT = "length int, hash long, at long, lead int, words array<string>"


def kept_grams(words: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Index and hash of the k-grams that winnowing keeps for spans of ``length`` words."""
    k = (length + 1) // 2
    gram = wordhash.grams(words, k)
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = gram[:n].copy()
    where = np.arange(n)
    for j in range(1, length - k + 1):
        other = gram[j : j + n]
        better = other <= least
        least[better] = other[better]
        where[better] = np.flatnonzero(better) + j
    kept = np.zeros(len(gram), bool)
    kept[where[owner[:n] == owner[length - 1 :]]] = True
    at = np.flatnonzero(kept)
    return at, gram[at]


class _Texts:
    """Words of some texts, and the kept k-grams with the words around them."""

    def __init__(self, texts: pa.Array) -> None:
        data, bounds = raw_bytes(texts)
        self.data = wordhash.LOWER[data]
        self.starts, self.ends, self.owner = wordhash.spans(self.data, bounds, wordhash.LETTERS)
        self.words = wordhash.hashes(self.data, self.starts, self.ends)
        self.counts = np.bincount(self.owner, minlength=len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.bytes = self.data.tobytes()

    def hits(self, length: int, wanted: np.ndarray | None, owners: np.ndarray | None = None) -> list[tuple[int, dict]]:
        """(text number, hit) for kept k-grams whose hash ``wanted`` can have."""
        at, gram = kept_grams(self.words, self.owner, length)
        if wanted is not None:
            slot = gram & np.uint64(8 * len(wanted) - 1)
            keep = wanted[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1 == 1
            at, gram = at[keep], gram[keep]
        if owners is not None:
            keep = owners[self.owner[at]]
            at, gram = at[keep], gram[keep]
        k = (length + 1) // 2
        found = []
        for i, h in zip(at.tolist(), gram.view(np.int64).tolist()):
            text = int(self.owner[i])
            low = max(int(self.first[text]), i - (length - k))
            high = min(int(self.first[text + 1]), i + length)
            around = [self.bytes[a:b].decode() for a, b in zip(self.starts[low:high], self.ends[low:high])]
            hit = {"length": length, "hash": h, "at": i - int(self.first[text]), "lead": i - low, "words": around}
            found.append((text, hit))
        return found


def _item_grams(items: DataFrame, window: int) -> DataFrame:
    """A row per kept k-gram of an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded_slices(batches):
            texts = _Texts(part.column(1))
            lengths = np.minimum(texts.counts, window)
            found = [
                hit for n in np.unique(lengths[lengths > 0]).tolist() for hit in texts.hits(n, None, lengths == n)
            ]
            ids = part.column(0).take(pa.array([t for t, _ in found], pa.int64()))
            hits = pa.array([h for _, h in found], _hit_type())
            yield pa.RecordBatch.from_arrays([ids, hits], ["item_id", "hit"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.mapInArrow(run, f"item_id {kind}, hit struct<{_fields()}>").select("item_id", "hit.*")


def _fields() -> str:
    return ", ".join(f.replace(" ", ":", 1) for f in HIT.split(", "))


def _hit_type() -> pa.StructType:
    return pa.struct(
        [("length", pa.int32()), ("hash", pa.int64()), ("at", pa.int64()), ("lead", pa.int32()), ("words", pa.list_(pa.string()))]
    )


def _possible(grams: DataFrame, bits: int) -> np.ndarray:
    """The table of ``bits`` bits (a power of two, 64 at least) of the benchmark's hashes."""
    slots = grams.selectExpr(
        f"shiftright(hash & {bits - 1}L, 6) AS word", "shiftleft(1L, cast(hash & 63L AS int)) AS bit"
    )
    words = slots.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return table.astype("<u8").view(np.uint8)


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal words around joined k-grams that reach the length asked for."""
    for batch in batches:
        keep, begin, end = [], [], []
        columns = [batch.column(c).to_pylist() for c in ("length", "at", "lead", "words", "item_lead", "item_words")]
        for i, (length, at, lead, words, item_lead, item_words) in enumerate(zip(*columns)):
            k = (length + 1) // 2
            if words[lead : lead + k] != item_words[item_lead : item_lead + k]:
                continue  # another k-gram of the same hash
            back = 0
            while back < min(lead, item_lead) and words[lead - back - 1] == item_words[item_lead - back - 1]:
                back += 1
            ahead = k
            most = min(len(words) - lead, len(item_words) - item_lead)
            while ahead < most and words[lead + ahead] == item_words[item_lead + ahead]:
                ahead += 1
            if back + ahead >= length:
                keep.append(i)
                begin.append(at - back)
                end.append(at + ahead)
        rows = batch.select(["row", "item_id"]).take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array(begin, pa.int64()), pa.array(end, pa.int64())], ["row", "item_id", "begin", "end"]
        )


def contaminated_words(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, doc_id: str = "doc_id", filter_bits: int = FILTER_BITS
) -> tuple[DataFrame, DataFrame]:
    """Two tables: (row, doc_id, n_words) of all documents; (row, item_id, begin, end) of runs of hit words."""
    spark: SparkSession = docs.sparkSession
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    grams = staged(_item_grams(items, window), "benchmark")
    lengths = sorted(r[0] for r in grams.select("length").distinct().collect())  # at most ``window``
    table = spark.sparkContext.broadcast(_possible(grams, filter_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded_slices(batches):
            texts = _Texts(part.column(1))
            hits: list[list[dict]] = [[] for _ in range(part.num_rows)]
            for length in lengths:
                for text, hit in texts.hits(length, table.value):
                    hits[text].append(hit)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(texts.counts.astype(np.int64)), pa.array(hits, pa.list_(_hit_type()))],
                ["doc_id", "n_words", "hits"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {kind}, n_words long, hits array<struct<{_fields()}>>")
    found = staged(found.select(F.monotonically_increasing_id().alias("row"), "*"), "winnowed")
    item_side = grams.select(
        "item_id", "length", "hash", F.col("lead").alias("item_lead"), F.col("words").alias("item_words")
    ).distinct()
    joined = (
        found.where(F.size("hits") > 0)
        .select("row", F.explode("hits").alias("hit"))
        .select("row", "hit.*")
        .join(item_side, ["length", "hash"])
    )
    item_kind = items.schema["item_id"].dataType.simpleString()
    runs = joined.mapInArrow(_extended, f"row long, item_id {item_kind}, begin long, end long")
    return found.select("row", "doc_id", "n_words"), runs


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, doc_id: str = "doc_id", filter_bits: int = FILTER_BITS
) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows, runs = contaminated_words(docs, benchmark, window, doc_id, filter_bits)
    runs = staged(runs, "hits")
    before = Window.partitionBy("row").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    new = F.col("end") - F.greatest("begin", F.coalesce(F.max("end").over(before), F.lit(0)))
    words = (
        runs.select("row", "begin", "end").distinct()
        .select("row", F.greatest(new, F.lit(0)).alias("new"))
        .groupBy("row").agg(F.sum("new").alias("n_hit"))
    )
    items = (
        runs.where("item_id is not null").select("row", F.col("item_id").cast("string").alias("item")).distinct()
        .groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    joined = rows.join(words, "row", "left").join(items, "row", "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs``, all columns, without a hit word.

    Whether a row goes depends on its text alone, so rows are matched by doc_id and the
    text's hash.
    """
    key, bad = fresh(docs, "key"), fresh(docs, "bad")
    keyed = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64(F.col("text").cast("string")))
    keyed = keyed.cast(f"struct<none:boolean,id:{docs.schema['doc_id'].dataType.simpleString()},hash:bigint>")
    found = contamination(docs.select(keyed.alias("doc_id"), "text"), benchmark, window)
    gone = found.where("contaminated").select(F.col("doc_id").alias(bad)).distinct()
    return docs.withColumn(key, keyed).join(gone, F.col(key) == F.col(bad), "left_anti").drop(key)
