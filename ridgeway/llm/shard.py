"""Rows dealt to weighted shards by rendezvous hashing of stable record keys.

Every shard gets a pseudo-random number u in (0, 1) from the hash of the key and the
shard's number; the row goes to the shard with the least -ln(u) / weight. Key, shard
numbers and weights decide alone, so results do not depend on row order, file layout
or lost executors, and a shard that is added takes rows only into itself.

Slots number the rows of a shard without gaps. The rows (without their texts) are
written once with their place in the written file; a block is at most ``BLOCK`` rows
of one file. Row numbers are taken within (shard, block), and blocks are offset by the
counts of those before them, so no task sorts a whole shard, also when one key or one
text fills it.

Defined cases: a null text has size 1 and the checksum of empty text; a null key is a
key of its own (the empty string); repeated rows go to the same shard and get slots of
their own; an empty table gives an empty result; other columns are not read.
Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeway.llm.common import staged

#: Rows of one file that are numbered together.
BLOCK_BITS = 16


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key, a number from 0; ties go to the lower number."""
    if not weights or any(not w > 0 or math.isinf(w) for w in weights):
        raise ValueError("weights must be positive and finite")
    key = F.coalesce(key.cast("string"), F.lit(""))

    def place(shard: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
        u = (bits + 0.5) / float(1 << 53)
        return F.struct((-F.log(u) / weight).alias("cost"), F.lit(shard).alias("shard"))

    return F.array_min(F.array(*[place(s, w) for s, w in enumerate(weights)]))["shard"]


def with_slots(rows: DataFrame, shard: str = "shard") -> DataFrame:
    """``rows`` with the column slot: numbers from 0 without gaps in each shard."""
    placed = staged(rows.select("*", F.monotonically_increasing_id().alias("_place")), "shards")
    placed = placed.withColumn("_block", F.shiftright("_place", BLOCK_BITS))
    counts = placed.groupBy(shard, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy(shard, "_block").orderBy("_place"))
    return (
        placed.withColumn("_within", within)
        .join(offsets, [shard, "_block"])
        .select(*rows.columns, (F.col("_offset") + F.col("_within") - 1).alias("slot"))
    )


def shards(
    docs: DataFrame,
    weights: Sequence[float] = (1.0,) * 16,
    added: float = 1.0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """A row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``grown_shard`` is the shard once one more of weight ``added`` is there.
    """
    key, body = F.col(doc_id), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        key.alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(key, weights).alias("shard"),
        rendezvous(key, [*weights, added]).alias("grown_shard"),
    )
    return with_slots(rows).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
