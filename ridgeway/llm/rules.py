"""Quality rules: fixed counts per text, and a hashed n-gram logistic regression as the verdict.

The counts: words are runs without ASCII white space; ``word_chars`` code points in
words; ``n_symbols`` characters of ``#*$%&|<>``; ``n_dup_lines`` lines with a word that
equal an earlier line; ``n_repeat_words`` words that lie in a window of three words
found at least twice. A text of under 50 words, or more than half of whose words are
repeated, fails. Of the others the model decides: the shares of hashed character
3-grams (of UTF-8 bytes) and of hashed words, a logistic regression on them trained on
labelled quality rows (AdaGrad), and a logistic calibration of its value on rows that it
was not trained on; kept if the calibrated probability reaches ``THRESHOLD``.

The model is fitted on at most about ``FIT_ROWS`` labelled documents, on those that pass the
rules, whose hashed counts reach the driver. Scoring reads each whole text once, in Arrow batches, without a shuffle.
Words, lines and windows are compared by 64-bit hashes.

Defined cases: null and empty texts have no words and fail; without usable labels of
both kinds the rules alone decide; repeated rows are judged each; null labels and ids
are not learnt from; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import bounded_slices
from ridgeway.llm.labelled import labelled_sample
from ridgeway.llm.textstats import TextStats

FIT_ROWS = 6_000
THRESHOLD = 0.5
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
#: Hash slots of character 3-grams, and as many of words after them.
SLOT_BITS = 15
SLOTS = 1 << SLOT_BITS
#: Shares are small; they are scaled to the order of one.
SCALE = 30.0


def base_counts(stats: TextStats) -> dict[str, np.ndarray]:
    kinds = stats.kinds
    counts = {
        "n_words": stats.n_words,
        "word_chars": np.diff(stats.bounds) - kinds["space"] - kinds["tail"],
        "n_symbols": kinds["symbol"] + kinds["bar"],
        "n_dup_lines": stats.repeated_lines()[0],
        "n_repeat_words": stats.words_in_repeats(3),
    }
    return {name: n.astype(np.int64) for name, n in counts.items()}


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    words = counts["n_words"]
    return (words < LEAST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED * words)


def _slots(stats: TextStats) -> tuple[np.ndarray, np.ndarray]:
    """Hash slots of all 3-grams (across text ends too) and of all words."""
    b = stats.data.astype(np.uint32)
    code = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
    grams = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)
    return grams.astype(np.int32), (stats.words >> np.uint64(64 - SLOT_BITS)).astype(np.int32) + SLOTS


def _gram_bounds(stats: TextStats) -> tuple[np.ndarray, np.ndarray]:
    first = np.minimum(stats.bounds[:-1], max(0, len(stats.data) - 2))
    return first, np.maximum(first, stats.bounds[1:] - 2)


def hashed_shares(stats: TextStats) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the used slots and their scaled shares of the text's 3-grams or words."""
    grams, words = _slots(stats)
    first, last = _gram_bounds(stats)
    word_ends = np.concatenate([[0], np.cumsum(stats.n_words)])
    out = []
    for i in range(stats.n):
        parts = []
        for slots in (grams[first[i] : last[i]], words[word_ends[i] : word_ends[i + 1]]):
            used, n = np.unique(slots, return_counts=True)
            parts.append((used, (SCALE * n / max(1, n.sum())).astype(np.float32)))
        out.append(tuple(np.concatenate(p) for p in zip(*parts)))
    return out


@dataclass
class HashedRegression:
    """Weights per slot, an offset, and the calibration of their sum."""

    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def value(self, stats: TextStats) -> np.ndarray:
        """The weighted sum of the shares of each text."""
        grams, words = _slots(stats)
        first, last = _gram_bounds(stats)
        sums = np.concatenate([[0.0], np.cumsum(self.weights[grams])])
        by_gram = (sums[last] - sums[first]) / np.maximum(last - first, 1)
        by_word = np.bincount(stats.owner, self.weights[words], stats.n) / np.maximum(stats.n_words, 1)
        return SCALE * (by_gram + by_word)

    def probability(self, stats: TextStats) -> np.ndarray:
        return _logistic(self.slope * self.value(stats) + self.offset)

    @classmethod
    def fit(
        cls, bounds: np.ndarray, slots: np.ndarray, shares: np.ndarray, y: np.ndarray, epochs: int = 12, rate: float = 0.3
    ) -> HashedRegression:
        """Rows i have slots[bounds[i]:bounds[i+1]]; every fourth row is kept for the calibration."""
        model = cls(np.zeros(2 * SLOTS))
        kept = np.arange(len(y)) % 4 == 3
        if not (0 < y[~kept].sum() < (~kept).sum()):
            return cls(model.weights, 0.0, 30.0)  # nothing to tell apart: all are kept
        square = np.full(2 * SLOTS, 1e-8)
        bias, bias_square = 0.0, 1e-8
        random = np.random.default_rng(6)
        sizes = np.diff(bounds)
        for _ in range(epochs):
            for rows in np.array_split(random.permutation(np.flatnonzero(~kept)), -(-int((~kept).sum()) // 256)):
                owner = np.repeat(np.arange(len(rows)), sizes[rows])
                at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes[rows]) - sizes[rows], sizes[rows])
                at += np.repeat(bounds[rows], sizes[rows])
                j, v = slots[at], shares[at]
                z = np.bincount(owner, model.weights[j] * v, len(rows)) + bias
                error = (_logistic(z) - y[rows]) / len(rows)
                slope = np.bincount(j, v * error[owner], 2 * SLOTS)
                square += slope * slope
                model.weights -= rate * slope / np.sqrt(square)
                bias_square += error.sum() ** 2
                bias -= rate * error.sum() / np.sqrt(bias_square)
        z = np.add.reduceat(np.append(model.weights[slots] * shares, 0.0), bounds[:-1]) * (sizes > 0)
        model.slope, model.offset = calibrated(z[kept], y[kept])
        return model


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def calibrated(z: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, steps: int = 100) -> tuple[float, float]:
    """Slope and offset of the logistic curve of y over z, with smoothed targets (damped Newton)."""
    w = np.ones(len(z)) if weight is None else weight
    up, down = (w * y).sum(), (w * (1 - y)).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    unit = max(float(z.std()), 1e-9)
    x = np.stack([z / unit, np.ones(len(z))], axis=1)

    def loss(theta: np.ndarray) -> float:
        v = x @ theta
        return float((w * (np.logaddexp(0, v) - target * v)).sum() + 5e-4 * theta @ theta)

    theta = np.zeros(2)
    for _ in range(steps):
        p = _logistic(x @ theta)
        h = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (w * (target - p)) - 1e-3 * theta)
        size = 1.0
        while size > 1e-6 and loss(theta + size * step) > loss(theta):
            size /= 2
        theta = theta + size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(theta[0]) / unit, float(theta[1])


def fit_rules(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> HashedRegression:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded_slices(batches):
            texts = part.column(part.schema.get_field_index("text"))
            # the model is asked only about texts that pass the rules
            asked = pa.array(~base_failed(base_counts(TextStats(texts))))
            part = part.filter(asked)
            found = hashed_shares(TextStats(part.column(part.schema.get_field_index("text"))))
            columns = [part.column(part.schema.get_field_index(c)) for c in ("doc_id", "label")]
            slots = pa.array([s for s, _ in found], pa.list_(pa.int32()))
            shares = pa.array([v for _, v in found], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*columns, slots, shares], ["doc_id", "label", "slots", "shares"])

    sample = labelled_sample(docs, labels, rows)
    kind = sample.schema["doc_id"].dataType.simpleString()
    hashed = sample.mapInArrow(run, f"doc_id {kind}, label int, slots array<int>, shares array<float>")
    one_each = hashed.groupBy("doc_id").agg(F.min(F.struct("label", "slots", "shares")).alias("row"))
    table = one_each.orderBy(F.xxhash64("doc_id"), "doc_id").select("row.*").toArrow()
    slots, shares = (table[c].combine_chunks() for c in ("slots", "shares"))
    if isinstance(slots, pa.ChunkedArray):
        slots, shares = (pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type) for c in (slots, shares))
    bounds = np.concatenate([[0], np.cumsum(slots.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))])
    return HashedRegression.fit(
        bounds, slots.flatten().to_numpy(), shares.flatten().to_numpy(), (table["label"].to_numpy() > 0).astype(float)
    )


def judged(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """A row per row of ``docs``: doc_id, the five counts, base_failed, probability, kept."""
    model = fit_rules(docs, labels, rows)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded_slices(batches):
            stats = TextStats(part.column(1))
            counts = base_counts(stats)
            failed = base_failed(counts)
            probability = model.probability(stats)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    *(pa.array(counts[n]) for n in names),
                    pa.array(failed),
                    pa.array(probability),
                    pa.array(~failed & (probability >= threshold)),
                ],
                ["doc_id", *names, "base_failed", "probability", "kept"],
            )

    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{n} long" for n in names)
    return chosen.mapInArrow(run, f"doc_id {kind}, {counts}, base_failed boolean, probability double, kept boolean")
