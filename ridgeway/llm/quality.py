"""Document quality by a generalised additive model with pairwise interactions.

A text is described by ``FEATURES``. Per feature, shallow trees are boosted in turn
(cyclically) on binned values; as each tree sees one feature, their sum is a lookup
table per feature. The pairs of features that explain most of what is left get tables
over two features in the same way. A score is the logistic function of the sum of the
looked-up values, taken for whole Arrow batches by indexing.

The model is fitted on at most about ``FIT_ROWS`` labelled documents, whose features
(not texts) reach the driver; labels of documents whose crc32(doc_id) mod 4 is 2 are
never used. Scoring reads each text once, without a shuffle.

Defined cases: null and empty texts have all features zero and are scored like others;
without any usable label every score is 0.5; equal texts have equal scores; repeated
rows are scored each; null labels and ids are not learnt from; an empty table gives an
empty result; extra columns are not read (``drop_rejected`` passes them on).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import bounded_slices, held_out
from ridgeway.llm.labelled import labelled_sample
from ridgeway.llm.textstats import TextStats

FEATURES = (
    "log_words", "word_bytes", "upper", "digits", "bangs", "bars", "symbols", "marks", "other",
    "beyond_ascii", "word_after_itself", "distinct_words", "repeated_lines", "words_per_line",
)
#: Labelled documents that the model is fitted on, about.
FIT_ROWS = 15_000
THRESHOLD = 0.7


def features(texts: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` per text."""
    stats = TextStats(texts)
    kinds, words = stats.kinds, np.maximum(stats.n_words, 1)
    letters = np.maximum(kinds["lower"] + kinds["upper"], 1)
    chars = np.maximum(np.diff(stats.bounds) - kinds["space"], 1)
    again, lines = stats.repeated_lines()
    return np.stack(
        [
            np.log2(stats.n_words + 1),
            (np.diff(stats.bounds) - kinds["space"]) / words,
            kinds["upper"] / letters,
            kinds["digit"] / chars,
            kinds["bang"] / words,
            kinds["bar"] / words,
            kinds["symbol"] / words,
            kinds["mark"] / words,
            kinds["other"] / words,
            kinds["lead"] / chars,
            stats.word_after_itself() / words,
            stats.distinct_words() / words,
            again / np.maximum(lines, 1),
            np.log2(stats.n_words / np.maximum(lines, 1) + 1),
        ],
        axis=1,
    ).round(9)


def _gain(g: np.ndarray, h: np.ndarray, smooth: float) -> np.ndarray:
    return g * g / (h + smooth)


def _shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int, smooth: float) -> np.ndarray:
    """Values per bin of a tree with at most ``leaves`` leaves over ordered bins."""
    sg, sh = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    pieces = [(0, len(g))]
    while len(pieces) < leaves:
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(pieces):
            cut = np.arange(a + 1, b)
            if len(cut):
                gain = (
                    _gain(sg[cut] - sg[a], sh[cut] - sh[a], smooth)
                    + _gain(sg[b] - sg[cut], sh[b] - sh[cut], smooth)
                    - _gain(sg[b] - sg[a], sh[b] - sh[a], smooth)
                )
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (gain[i], k, int(cut[i]))
        if best[1] is None:
            break
        a, b = pieces.pop(best[1])
        pieces += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in pieces:
        out[a:b] = (sg[b] - sg[a]) / (sh[b] - sh[a] + smooth)
    return out


def _crossed_tree(g: np.ndarray, h: np.ndarray, smooth: float) -> tuple[np.ndarray, float]:
    """Values of the best tree that cuts both axes of a grid once, and its gain."""

    def quarters(x: np.ndarray) -> list[np.ndarray]:
        s = np.zeros((x.shape[0] + 1, x.shape[1] + 1))
        s[1:, 1:] = x.cumsum(0).cumsum(1)
        low = s[1:-1, 1:-1]
        top, left = s[1:-1, -1:], s[-1:, 1:-1]
        return [low, top - low, left - low, s[-1, -1] - top - left + low]

    gs, hs = quarters(g), quarters(h)
    gain = sum(_gain(a, b, smooth) for a, b in zip(gs, hs))
    if not gain.size:
        return np.zeros(g.shape), 0.0
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    value = [a[i, j] / (b[i, j] + smooth) for a, b in zip(gs, hs)]
    out = np.empty(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = value
    return out, float(gain[i, j])


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Cuts at quantiles of the values and of the distinct values, halfway to the value below."""
    distinct = np.unique(x)
    if len(distinct) < 2:
        return np.zeros(0)
    q = np.linspace(0, 1, bins // 2 + 1)
    at = np.unique(np.concatenate([np.quantile(v, q, method="nearest") for v in (x, distinct)]))
    above = np.searchsorted(distinct, at[1:] if at[0] == distinct[0] else at)
    return np.unique((distinct[above] + distinct[above - 1]) / 2)


@dataclass
class AdditiveModel:
    """Lookup tables per feature and per pair of features."""

    start: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    @staticmethod
    def _bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for b, table in zip(self._bins(x, self.edges), self.tables):
            total += table[b]
        wide = self._bins(x, self.coarse)
        for (i, j), grid in zip(self.pairs, self.grids):
            total += grid[wide[i], wide[j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))

    @classmethod
    def fit(
        cls,
        x: np.ndarray,
        y: np.ndarray,
        rounds: int = 80,
        rate: float = 0.15,
        bins: int = 64,
        pairs: int = 6,
        smooth: float = 1.0,
    ) -> AdditiveModel:
        model = cls(start=float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))))
        if not 0 < y.sum() < len(y):
            return model
        model.edges = [_edges(x[:, j], bins) for j in range(x.shape[1])]
        model.coarse = [e[np.unique(np.linspace(0, len(e) - 1, 7).astype(int))] if len(e) else e for e in model.edges]
        model.tables = [np.zeros(len(e) + 1) for e in model.edges]
        fine, wide = cls._bins(x, model.edges), cls._bins(x, model.coarse)
        total = np.full(len(y), model.start)

        def slopes() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-total))
            return y - p, p * (1 - p)

        for _ in range(rounds):
            for j, table in enumerate(model.tables):
                g, h = (np.bincount(fine[j], v, len(table)) for v in slopes())
                step = rate * _shallow_tree(g, h, 4, smooth)
                table += step
                total += step[fine[j]]

        def grid(i: int, j: int, value: np.ndarray) -> np.ndarray:
            shape = len(model.coarse[i]) + 1, len(model.coarse[j]) + 1
            return np.bincount(wide[i] * shape[1] + wide[j], value, shape[0] * shape[1]).reshape(shape)

        g, h = slopes()
        gains = {(i, j): _crossed_tree(grid(i, j, g), grid(i, j, h), smooth)[1] for i, j in combinations(range(x.shape[1]), 2)}
        model.pairs = sorted(gains, key=lambda p: (-gains[p], p))[:pairs]
        model.grids = [np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)) for i, j in model.pairs]
        for _ in range(rounds // 4):
            for (i, j), table in zip(model.pairs, model.grids):
                g, h = slopes()
                step = rate * _crossed_tree(grid(i, j, g), grid(i, j, h), smooth)[0]
                table += step
                total += step[wide[i], wide[j]]
        return model


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> AdditiveModel:
    """The model of the labels that may be learnt from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded_slices(batches):
            x = features(part.column(part.schema.get_field_index("text")))
            columns = [part.column(part.schema.get_field_index(c)) for c in ("doc_id", "label")]
            yield pa.RecordBatch.from_arrays(
                [*columns, *(pa.array(x[:, j]) for j in range(x.shape[1]))], ["doc_id", "label", *FEATURES]
            )

    sample = labelled_sample(docs, labels, rows)
    kind = sample.schema["doc_id"].dataType.simpleString()
    described = sample.mapInArrow(run, f"doc_id {kind}, label int, " + ", ".join(f"{f} double" for f in FEATURES))
    one_each = described.groupBy("doc_id").agg(F.min(F.struct("label", *FEATURES)).alias("row")).select("row.*")
    table = one_each.toArrow()
    x = np.stack([table[f].to_numpy() for f in FEATURES], axis=1)
    y = (table["label"].to_numpy() > 0).astype(float)
    order = np.lexsort([*x.T, y])  # sums in the same order in every run
    return AdditiveModel.fit(x[order], y[order])


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """A row per row of ``docs``: doc_id, held_out, score, predicted."""
    model = fit_quality(docs, labels, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded_slices(batches):
            score = model.score(features(part.column(2)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    chosen = docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def drop_rejected(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold; all if no label is usable."""
    if labelled_sample(docs, labels, rows).isEmpty():
        return docs
    model = fit_quality(docs, labels, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded_slices(batches):
            score = model.score(features(part.column(part.schema.get_field_index("text"))))
            yield part.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)
