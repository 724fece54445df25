"""Documents packed into token sequences by a configuration linear program.

A document is its ids and the id 0; longer ones than a sequence are cut into full
pieces and a rest. Only the histogram of piece lengths (at most ``capacity`` numbers,
whatever the corpus) reaches the driver. There a configuration is a set of lengths
that fit into one sequence, and the program asks for the least number of
configurations that cover the histogram. Multiplicative weights solve it: each round
a knapsack dynamic program prices the configuration that is worth most at the present
weights, it and those nearly as dear are used, and the weights of what they cover
sink. The fractional uses are rounded down, and what is left is packed best fit
decreasing, also on the histogram. Where that needs over ``GAP`` more sequences than the
tokens fill, small steps with averaged uses are taken as well, until they are within
``GAP`` of the dual bound or ``SMALL_STEPS`` are done, and the better packing is kept.

The rank of a piece among those of its length (a count within its task, and an offset
per task and length) decides its place, so no group of equal lengths is gathered.

Defined cases: null and empty texts are the id 0 alone; repeated rows are packed as
often as they occur; an empty table gives an empty result; a null id keeps its row;
other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeway.llm.common import Shared, bounded_slices, staged
from ridgeway.llm.tokens import WordEncoder

#: (((length, copies), ...), number of sequences)
Pattern = tuple[tuple[tuple[int, int], ...], int]

#: Of the multiplicative weights: rounds at most, steepness of the weights, first prices as
#: a power of the length, and which configurations a round uses.
ROUNDS = 120
SHARPNESS = 0.5
POWER = 1.2
NEAR = 0.01
#: Of the averaged uses: wanted gap to the bound, share of a length that a step covers, steps at most.
GAP = 0.002
STEP = 0.02
SMALL_STEPS = 400
BATCH = 64


def tokenizer_path() -> str:
    """The vocabulary used where no other file is named."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _priced(price: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Greatest total price within each room, and the length to take there (0: leave one token free)."""
    best = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, np.int64)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(int(lengths[0]), capacity + 1):
        total = best[room - lengths[: upto[room]]] + price[: upto[room]]
        i = int(total.argmax())
        if total[i] > best[room - 1]:
            best[room], taken[room] = total[i], lengths[i]
        else:
            best[room] = best[room - 1]
    return best, taken


def _content(first: int, room: int, taken: np.ndarray) -> tuple[tuple[int, int], ...]:
    """The configuration of ``first`` and the dearest content of ``room``: (length, copies), descending."""
    copies: dict[int, int] = defaultdict(int)
    copies[first] += 1
    while room > 0:
        if taken[room]:
            copies[int(taken[room])] += 1
            room -= int(taken[room])
        else:
            room -= 1
    return tuple(sorted(copies.items(), reverse=True))


def _configurations(counts: np.ndarray) -> dict[tuple[tuple[int, int], ...], float]:
    """Configurations with their fractional uses, by multiplicative weights.

    Prices start a little steeper than the length (which is the dual solution of a perfect
    packing), so that long pieces are placed while short ones are left to fill up, and sink
    with the share of a length that is covered. Each round uses configurations that are
    within ``NEAR`` of the dearest, at most ``BATCH`` of them.
    """
    capacity = len(counts) - 1
    need = counts.astype(float)
    left = need.copy()
    uses: dict[tuple[tuple[int, int], ...], float] = defaultdict(float)
    for _ in range(ROUNDS):
        lengths = np.flatnonzero(left > 1e-9)
        if not len(lengths):
            break
        covered = 1 - left[lengths] / need[lengths]
        price = (lengths / capacity) ** POWER * np.exp(-SHARPNESS * (covered - covered.min()))
        best, taken = _priced(price, lengths, capacity)
        worth = price + best[capacity - lengths]
        near = np.flatnonzero(worth >= (1 - NEAR) * worth.max())
        for i in near[::-1][:BATCH]:
            config = _content(int(lengths[i]), capacity - int(lengths[i]), taken)
            use = min(left[v] / a for v, a in config)
            for v, a in config:
                left[v] = max(0.0, left[v] - use * a)
            if use > 0:
                uses[config] += use
    return uses


def _averaged(counts: np.ndarray) -> dict[tuple[tuple[int, int], ...], float]:
    """Configurations with the averaged uses of many small steps.

    A step uses the dearest configuration until a share ``STEP`` of one of its lengths is
    covered. Lengths covered less than others become dearer. The uses so far, scaled until
    every length is covered, are a solution; prices by the dearest worth are a bound.
    """
    capacity = len(counts) - 1
    lengths = np.flatnonzero(counts)
    need = counts[lengths].astype(float)
    at = {int(v): i for i, v in enumerate(lengths)}
    done, bound, least = np.zeros(len(lengths)), 0.0, np.inf
    uses: dict[tuple[tuple[int, int], ...], float] = defaultdict(float)
    best: dict[tuple[tuple[int, int], ...], float] = {}
    for _ in range(SMALL_STEPS):
        price = lengths / capacity * np.exp(-SHARPNESS * (done - done.min()))
        dearest, taken = _priced(price, lengths, capacity)
        worth = price + dearest[capacity - lengths]
        i = int(worth.argmax())
        bound = max(bound, float(price @ need / worth[i]))
        config = _content(int(lengths[i]), capacity - int(lengths[i]), taken)
        use = STEP * min(need[at[v]] / a for v, a in config)
        uses[config] += use
        for v, a in config:
            done[at[v]] += use * a / need[at[v]]
        if done.min() > 0 and sum(uses.values()) / done.min() < least:
            least = sum(uses.values()) / done.min()
            best = {c: n / done.min() for c, n in uses.items()}
        if least <= (1 + GAP) * bound:
            break
    return best


def best_fit(counts: np.ndarray) -> list[Pattern]:
    """Best fit decreasing over a histogram; equal sequences are kept as one with a count."""
    capacity = len(counts) - 1
    open_: dict[int, list[Pattern]] = defaultdict(list)
    rooms: list[int] = []
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        waiting: list[int] = []
        while left:
            while rooms and (rooms[0] < length or not open_.get(rooms[0])):
                room = heapq.heappop(rooms)
                if open_.get(room):
                    waiting.append(room)
            if rooms:
                room = rooms[0]
                content, n = open_[room].pop()
            else:
                room, content, n = capacity, (), left
            each = room // length
            full = min(n, left // each)
            parts = [(each, full)]
            if full < n and left % each and left // each == full:
                parts.append((left % each, 1))
            for copies, times in parts:
                if times:
                    rest = room - copies * length
                    open_[rest].append(((*content, (length, copies)), times))
                    waiting.append(rest)
                    left -= copies * times
                    n -= times
            if content and n:
                open_[room].append((content, n))
        for room in set(waiting):
            heapq.heappush(rooms, room)
    return [pattern for group in open_.values() for pattern in group]


def pack_histogram(counts: np.ndarray) -> list[Pattern]:
    """Patterns that hold counts[v] pieces of each length v in sequences of len(counts) - 1."""
    counts = counts.astype(np.int64)
    capacity = len(counts) - 1
    full = int(counts[capacity])
    rest = counts.copy()
    rest[capacity] = 0
    patterns: list[Pattern] = [(((capacity, 1),), full)] if full else []
    if not rest.any():
        return patterns
    found = _rounded(rest, _configurations(rest))
    tokens = int((rest * np.arange(capacity + 1)).sum())
    if sum(n for _, n in found) > (1 + GAP) * tokens / capacity + 1:
        found = min(found, _rounded(rest, _averaged(rest)), key=lambda x: sum(n for _, n in x))
    return patterns + found


def _rounded(counts: np.ndarray, uses: dict[tuple[tuple[int, int], ...], float]) -> list[Pattern]:
    """Uses rounded down, and what is left best fit decreasing."""
    left = counts.copy()
    patterns: list[Pattern] = []
    for config, use in sorted(uses.items(), key=lambda x: -x[1]):
        times = min(int(use + 1e-6), *(int(left[v]) // a for v, a in config))
        if times > 0:
            patterns.append((config, times))
            for v, a in config:
                left[v] -= times * a
    return patterns + best_fit(left)


class _Places:
    """Where the r-th piece of a length goes."""

    SHIFT = np.int64(44)

    def __init__(self, patterns: list[Pattern]) -> None:
        used: dict[int, int] = defaultdict(int)
        rows, first = [], 0
        for content, times in patterns:
            offset = 0
            for length, copies in content:
                rows.append(((length << 44) + used[length], copies, first, offset))
                used[length] += copies * times
                offset += length * copies
            first += times
        rows.sort()
        self.key, self.copies, self.first, self.offset = (np.array(c, np.int64) for c in zip(*rows))

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length << self.SHIFT) + rank
        i = np.searchsorted(self.key, key, "right") - 1
        nth, copy = np.divmod(key - self.key[i], self.copies[i])
        return self.first[i] + nth, self.offset[i] + copy * length


def pieces(docs: DataFrame, capacity: int, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns doc_id, piece, start, length, ids_crc32, task, nth (rank in the task among its length)."""
    with open(tokenizer, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(definition.value)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for part in bounded_slices(batches):
            owner, number, start, length, crc, nth = [], [], [], [], [], []
            for i, body in enumerate(part.column(1).to_pylist()):
                ids = memoryview(encoder.ids(body or "") + b"\0\0\0\0")
                total = len(ids) // 4
                for k, a in enumerate(range(0, total, capacity)):
                    size = min(capacity, total - a)
                    owner.append(i)
                    number.append(k)
                    start.append(a)
                    length.append(size)
                    crc.append(zlib.crc32(ids[4 * a : 4 * (a + size)]))
                    nth.append(int(seen[size]))
                    seen[size] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(owner, pa.int64())),
                    pa.array(number, pa.int32()),
                    *(pa.array(c, pa.int64()) for c in (start, length, crc)),
                    pa.array([task] * len(owner), pa.int32()),
                    pa.array(nth, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long"
    )


def pack(
    docs: DataFrame, capacity: int = 2048, tokenizer: str | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = staged(pieces(docs, capacity, tokenizer or tokenizer_path(), doc_id, text), "pieces")
    counts = cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        histogram[row["length"]] = row["n"]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    out = [*(cut.schema[c] for c in columns)]
    if not histogram.any():
        return cut.selectExpr(*columns, "0L AS sequence_id", "0L AS offset")
    places = Shared(docs.sparkSession, _Places(pack_histogram(histogram)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = cut.join(offsets, ["task", "length"]).select(*columns, (F.col("before") + F.col("nth")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = places.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = place(length.astype(np.int64), rank.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.select(columns).columns, pa.array(sequence), pa.array(offset)],
                [*columns, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out)
    return ranked.mapInArrow(run, f"{kinds}, sequence_id long, offset long")
