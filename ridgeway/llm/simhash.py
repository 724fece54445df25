"""Near-duplicate documents by SimHash fingerprints, compared in bit-sliced blocks.

A fingerprint bit is 1 if it is set in over half the XXH64 hashes (seed 42) of the
document's word shingles. Two fingerprints link if they differ in at most ``radius``
bits; groups are the connected components of the links.

How links are found: the 64 bits are cut into ``radius + 2`` blocks. Fingerprints
within the radius agree in at least two blocks, so for each pair of blocks the
distinct fingerprints that agree there form a bucket. A bucket is stored as bit
planes (word k holds bit k of 64 fingerprints). A fingerprint is compared with 64
others at once: XOR with a plane, then a carry-save counter of two or more bit
slices; a word all of whose 64 counters have passed the radius is abandoned.
A bucket of more than ``FULL`` fingerprints is not compared as it is: the bits that its
members need not agree in are cut into ``radius + 1`` further blocks, of which a pair
within the radius agrees in one at least, and so on until no bucket is overfull. A
bucket of more than ``CHUNK`` is cut into chunks, and each pair of chunks is a task row
of its own. A task row returns a spanning forest of its links, never all pairs.

Defined cases: null and empty texts have fingerprint zero and link like any other;
a text with fewer words than a shingle has its whole word sequence as its only
shingle; repeated rows and equal texts share a fingerprint and so a component; a
null doc_id keeps its row and is left out of the minimum (a component of null ids
alone has a null id); an empty table gives an empty result; other columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import bounded_slices, fresh, staged, texts_as_bytes
from ridgeway.llm.components import components

SEED = 42
BITS = 64
#: Fingerprints in one block of a large bucket.
CHUNK = 4096
#: Fingerprints of a bucket that is compared without further blocks.
FULL = 4 * CHUNK
#: Comparisons of a fingerprint with a word of 64 that are worked on at once.
STEP = 1 << 16
#: Shingle hashes that are counted at once.
HASHES = 1 << 17
#: Row b: the bits of byte b, most significant first.
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)


def _digests(text: bytes, width: int) -> Iterator[bytes]:
    words = text.lower().split()
    if not words:
        return
    if len(words) < width:
        yield xxhash.xxh64_digest(b" ".join(words), SEED)
        return
    joined = b" ".join(words)
    starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])])
    digest = xxhash.xxh64_digest
    for at in range(0, len(words) - width + 1, HASHES):
        first = starts[at : min(at + HASHES, len(words) - width + 1)].tolist()
        last = starts[at + width : at + width + len(first)].tolist()
        yield b"".join([digest(joined[a : b - 1], SEED) for a, b in zip(first, last)])


def _count_bits(owners: list[int], digests: list[bytes], counts: np.ndarray) -> None:
    """Add the set bits of each owner's hashes to its row of ``counts``."""
    sizes = [len(d) // 8 for d in digests]
    hashes = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8)
    low = owners[0]
    rows = np.repeat(np.array(owners, np.int64) - low, sizes) * 256
    span = owners[-1] - low + 1
    for byte in range(8):
        seen = np.bincount(rows + hashes[:, byte], minlength=span * 256).reshape(span, 256)
        counts[low : low + span, byte * 8 : byte * 8 + 8] += (seen @ BYTE_BITS).astype(np.int64)


def fingerprint_texts(texts: list[bytes], width: int) -> np.ndarray:
    """The unsigned 64-bit fingerprint of each text."""
    counts = np.zeros((len(texts), BITS), np.int64)
    totals = np.zeros(len(texts), np.int64)
    owners: list[int] = []
    digests: list[bytes] = []
    waiting = 0
    for i, text in enumerate(texts):
        for part in _digests(text, width):
            totals[i] += len(part) // 8
            owners.append(i)
            digests.append(part)
            waiting += len(part) // 8
            if waiting >= HASHES:
                _count_bits(owners, digests, counts)
                owners, digests, waiting = [], [], 0
    if owners:
        _count_bits(owners, digests, counts)
    bits = (2 * counts > totals[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, width: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns (doc_id, fp) with the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded_slices(batches):
            prints = fingerprint_texts(texts_as_bytes(part.column(1)), width)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fp"]
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def _join_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of ``a`` and ``b`` in place; afterwards every entry points to its root."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up


def bucket_roots(prints: np.ndarray, bounds: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint the index of its root among those of its bucket that it reaches.

    ``bounds`` has the offsets of the buckets in ``prints``; only fingerprints of one
    bucket are compared.
    """
    n = len(prints)
    root = np.arange(n)
    sizes = np.diff(bounds)
    bucket = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(n) - bounds[:-1][bucket]
    words = (sizes + 63) // 64
    first_word = np.concatenate([[0], np.cumsum(words)])
    word = first_word[bucket] + within // 64
    lane = (within % 64).astype(np.uint64)
    heads = np.flatnonzero(np.diff(word, prepend=-1))
    one = np.uint64(1)
    planes = np.empty((BITS, len(heads)), np.uint64)
    for k in range(BITS):
        planes[k] = np.bitwise_or.reduceat(((prints >> np.uint64(k)) & one) << lane, heads)
    # lanes after a fingerprint's own, in its own word
    valid = np.bitwise_or.reduceat(one << lane, heads)
    slices = radius.bit_length()
    start = (1 << slices) - radius - 1  # counters overflow at radius + 1
    spans = first_word[bucket + 1] - word
    ends = np.cumsum(spans)
    at = 0
    while at < n:
        done = int(ends[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, done + STEP, "right")))
        q = np.repeat(np.arange(at, upto), spans[at:upto])
        w = word[q] + np.arange(len(q)) - np.repeat(ends[at:upto] - spans[at:upto] - done, spans[at:upto])
        live = valid[w].copy()
        own = w == word[q]
        live[own] &= ~((one << lane[q[own]]) | ((one << lane[q[own]]) - one))
        keep = live != 0
        q, w, live = q[keep], w[keep], live[keep]
        value = prints[q]
        counters = [np.full(len(q), ~np.uint64(0) if start >> j & 1 else 0, np.uint64) for j in range(slices)]
        for k in range(BITS):
            if not len(q):
                break
            carry = planes[k, w] ^ (np.uint64(0) - ((value >> np.uint64(k)) & one))
            for j in range(slices):
                counters[j], carry = counters[j] ^ carry, counters[j] & carry
            live &= ~carry
            if k % 8 == 7:
                keep = live != 0
                if keep.mean() < 0.75:
                    q, w, live, value = q[keep], w[keep], live[keep], value[keep]
                    counters = [c[keep] for c in counters]
        if len(q):
            bits = np.unpackbits(live.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, lanes = np.nonzero(bits)
            _join_roots(root, q[row], heads[w[row]] + lanes)
        at = upto
    return root


def _block_masks(radius: int) -> list[int]:
    """The bits that each table of buckets agrees in: two of ``radius + 2`` blocks."""
    cuts = np.linspace(0, BITS, radius + 3).astype(int)
    blocks = [sum(1 << k for k in range(a, b)) for a, b in zip(cuts, cuts[1:])]
    return [a | b for a, b in combinations(blocks, 2)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _finer_masks(mask: int, radius: int) -> list[int]:
    """``mask`` with one more block each: one of ``radius + 1`` into which its free bits are cut.

    Fingerprints within the radius that agree in ``mask`` agree in one of these too. Too few
    free bits to cut give an empty list; such a bucket has at most ``2 ** radius`` members.
    """
    free = [k for k in range(BITS) if not mask >> k & 1]
    if len(free) <= radius:
        return []
    cuts = np.linspace(0, len(free), radius + 2).astype(int)
    return [mask | sum(1 << k for k in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def _keys(masks: list[int], first: int = 0) -> Column:
    """A struct (t, key) for each mask: the number of its table, and what it leaves of ``fp``."""
    return F.array(
        *[
            F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(mask)).cast("long")).alias("key"))
            for t, mask in enumerate(masks, first)
        ]
    )


def _cells(members: DataFrame) -> DataFrame:
    """Lists ``fps`` of the buckets' members (t, key, fp, n); a large one is cut into pairs of chunks."""
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    placed = members.select("t", "key", "fp", F.pmod(F.hash("fp"), chunks).alias("own"), chunks.alias("chunks"))
    # a row for every pair of chunks that its chunk is part of
    return (
        placed.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .groupBy("t", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
        .agg(F.collect_list("fp").alias("fps"))
        .select("fps")
    )


def shared_buckets(distinct: DataFrame, radius: int) -> DataFrame:
    """Lists ``fps`` of distinct fingerprints: those within the radius meet in one of them at least."""
    masks = _block_masks(radius)
    keyed = distinct.select("fp", F.explode(_keys(masks)).alias("k")).select("fp", "k.t", "k.key")
    cells = []
    while True:
        finer = {t: more for t, mask in enumerate(masks) if (more := _finer_masks(mask, radius))}
        # written, so that the join has two plain inputs and Spark can split a large bucket's
        shared = staged(keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
        overfull = (F.col("n") > FULL) & F.col("t").isin(list(finer))
        members = keyed.join(shared, ["t", "key"])
        cells.append(_cells(members.where(~overfull)))
        # at most a row for each table
        tables = sorted(row["t"] for row in shared.where(overfull).select("t").distinct().collect())
        if not tables:
            return reduce(DataFrame.union, cells)
        rest = staged(members.where(overfull).select("fp", "t"), "overfull")
        masks, keys = [], F.lit(None)
        for t in tables:
            keys = F.when(F.col("t") == t, _keys(finer[t], len(masks))).otherwise(keys)
            masks += finer[t]
        keyed = rest.select("fp", F.explode(keys).alias("k")).select("fp", "k.t", "k.key")


def near_links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that span the components of the distinct fingerprints in column fp."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(0)
            bounds = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy()[bounds[0] : bounds[-1]]
            root = bucket_roots(values.view(np.uint64), bounds - bounds[0], radius)
            moved = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[moved]), pa.array(values[root[moved]])], ["a", "b"]
            )

    return shared_buckets(distinct, radius).mapInArrow(run, "a long, b long").distinct()


def simhash_groups(
    docs: DataFrame, width: int = 3, radius: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    prints = staged(fingerprints(docs, width, doc_id, text), "simhash")
    distinct = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(near_links(distinct, radius), "a", "b")
    linked = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = staged(linked.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    named = linked.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """One row of each group, all columns: the one whose doc_id is the least of the group.

    Of repeated rows and different texts of that id one stays, by the text's hash; of a
    group without ids one text without an id.
    """
    names = docs.columns
    key, kept = fresh(docs, "key"), fresh(docs, "kept")
    keyed = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64(F.col("text").cast("string")))
    keyed = keyed.cast(f"struct<none:boolean,id:{docs.schema['doc_id'].dataType.simpleString()},hash:bigint>")
    groups = simhash_groups(docs.select(keyed.alias("doc_id"), "text"), width, radius)
    first = groups.select(F.col("component_id").alias(kept)).distinct()
    chosen = docs.withColumn(key, keyed).join(first, F.col(key) == F.col(kept))
    return chosen.dropDuplicates([key]).select(*names)  # rows repeated as a whole
