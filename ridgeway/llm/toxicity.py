"""Toxicity: a weighted lexicon, learnt from labels, matched by Aho-Corasick on folded texts.

Folding: lower case, compatibility forms, look-alikes of other scripts, digits and signs that
stand for letters next to one, no invisible characters; ``l`` and ``1`` count as ``i``. A text
becomes its words (runs of letters and digits), each between two marks, so that an entry can be
a beginning of words, a whole word or a phrase, and one automaton finds them all: at every word
the longest entry counts, which is how an exception (an entry of weight 0 that is longer than
another) overrules it.

The lexicon: of every beginning of 3 to 16 characters and every whole word, the number of
labelled texts with and without a toxic label that hold such a word. A beginning enters if toxic
texts hold it far more often than chance (G-test) and its smoothed log-odds, the weight, are high;
of beginnings with the same counts only the longest. A longer one below it enters only if
its odds differ clearly, with weight 0 where it isn't toxic. Phrases of a matched word and a
neighbour that clean texts hold are exceptions, found by a second look at the sample.

Score: a logistic curve over the matched weight, as a total and per word of the text, fitted on a
quarter of the sample that the lexicon has not seen. All of it is fitted on at most about
``FIT_ROWS`` labelled documents; texts that share their least word hash (copies, near copies)
count once. Scoring reads each whole text once, in Arrow batches, without a shuffle.

Defined cases: null and empty texts have no words and get the score of a text without matches;
without usable labels of both kinds nothing is learnt and the score is 0; repeated rows are
scored each; null labels and ids are not learnt from; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import bounded_slices

FIT_ROWS = 10_000
THRESHOLD = 0.5
#: Lengths of the beginnings that can become entries, and how many entries a lexicon may have.
LEAST, MOST = 3, 16
LEXICON = 20_000
#: An entry needs this much evidence (G, one degree of freedom) and these log-odds above the sample's.
EVIDENCE, ODDS = 16.0, 1.2
#: Pseudo-texts at the sample's own share of toxic ones.
SMOOTHING = 1.0
#: Marks around a word.
OPEN, CLOSE = "\x01", "\x02"

# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "ɡ": "g", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ц": "u", "ѵ": "v", "ԝ": "w",
    "х": "x", "у": "y", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o",
    "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i",
}
# Digits and signs that are written for letters.
SUBSTITUTES = {"0": "o", "1": "l", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l"}
# Characters that show nothing.
INVISIBLE = "­​‌‍⁠﻿"

_ALIKE = str.maketrans(LOOK_ALIKES | dict.fromkeys(INVISIBLE, ""))
_FOREIGN = re.compile("[" + "".join(LOOK_ALIKES) + INVISIBLE + "]")
_FOR_LETTERS = str.maketrans(SUBSTITUTES)
#: Beside a letter: before it any of them, after it digits only (a sign there is punctuation).
_WRITTEN = re.compile(r"[0-9@$!|]+(?=[^\W\d_])|(?<=[^\W\d_])[0-9]+")
_DIGIT_OR_SIGN = re.compile(r"[0-9@$!|]")
_WORD = re.compile(r"[^\W_]+")


def folded_words(text: str | None) -> list[str]:
    """The words of a text, folded."""
    if not text:
        return []
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).lower()
        if _FOREIGN.search(text):
            text = text.translate(_ALIKE)
    if _DIGIT_OR_SIGN.search(text):
        text = _WRITTEN.sub(lambda m: m[0].translate(_FOR_LETTERS), text)
    return _WORD.findall(text.replace("l", "i"))


def marked(words: list[str]) -> str:
    return OPEN + (CLOSE + OPEN).join(words) + CLOSE if words else ""


def readable(entry: str) -> str:
    """An entry as it is listed: words with spaces, a beginning with a star."""
    return entry.replace(CLOSE + OPEN, " ").replace(OPEN, "").replace(CLOSE, " ").strip() + ("" if entry.endswith(CLOSE) else "*")


@dataclass
class Lexicon:
    """Weights of entries, and the curve over what a text matches."""

    weights: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, ...] = (-30.0, 0.0, 0.0)

    def automaton(self):
        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (entry, weight))
        if self.weights:
            found.make_automaton()
        return found

    def matches(self, words: list[str], automaton) -> list[tuple[int, str, float]]:
        """(last position, entry, weight) of the longest entry at each matched word, left to right."""
        if not words or not self.weights:
            return []
        return [(end, entry, weight) for end, (entry, weight) in automaton.iter_long(marked(words))]

    def measured(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, matches with a weight and the sum of their weights, of each text."""
        automaton = self.automaton()
        out = np.zeros((3, len(texts)))
        for i, text in enumerate(texts):
            words = folded_words(text)
            hits = [w for _, _, w in self.matches(words, automaton) if w > 0]
            out[:, i] = len(words), len(hits), sum(hits)
        return out[0], out[1], out[2]

    def score(self, n_words: np.ndarray, weight: np.ndarray) -> np.ndarray:
        return _logistic(_features(n_words, weight) @ np.array(self.curve))


def _features(n_words: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """1, the total, and the share of the text's length, both on a slow scale."""
    return np.stack([np.ones(len(weight)), np.log1p(weight), np.log1p(100 * weight / (n_words + 10))], axis=1)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fitted_curve(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, ...]:
    """Logistic regression with a small penalty on the slopes (damped Newton)."""
    penalty = np.diag([1e-3, *[0.05] * (x.shape[1] - 1)])

    def loss(theta: np.ndarray) -> float:
        z = x @ theta
        return float((np.logaddexp(0, z) - y * z).sum() + theta @ penalty @ theta / 2)

    theta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = _logistic(x @ theta)
        slope = x.T @ (p - y) + penalty @ theta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, slope)
        size = 1.0
        while size > 1e-6 and loss(theta - size * step) > loss(theta):
            size /= 2
        theta = theta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return tuple(float(t) for t in theta)


def log_odds(toxic: float, clean: float, share: float) -> float:
    """Smoothed log-odds of a toxic text, above those of the sample."""
    prior = np.log(share / (1 - share))
    return float(np.log((toxic + SMOOTHING * share) / (clean + SMOOTHING * (1 - share))) - prior)


def evidence(toxic: float, clean: float, share: float) -> float:
    """G of the counts against a share of toxic texts."""
    n = toxic + clean
    terms = [x * np.log(x / (n * s)) for x, s in ((toxic, share), (clean, 1 - share)) if x > 0]
    return float(2 * sum(terms))


def chosen_entries(counts: list[tuple[str, int, int]], share: float) -> dict[str, float]:
    """Weights of the entries worth having, of (entry, toxic texts, clean texts); see the module's text."""
    table = {e: (t, c) for e, t, c in counts}
    # a beginning with the counts of a longer one says nothing that the longer one doesn't say better
    shadowed = {e[:-1] for e, tc in table.items() if table.get(e[:-1]) == tc}
    weights: dict[str, float] = {}
    for entry in sorted(table, key=lambda e: (len(e), e)):
        if entry in shadowed:
            continue
        toxic, clean = table[entry]
        above = next((entry[:k] for k in range(len(entry) - 1, LEAST, -1) if entry[:k] in weights), None)
        odds = log_odds(toxic, clean, share)
        if above is None:
            if odds >= ODDS and evidence(toxic, clean, share) >= EVIDENCE:
                weights[entry] = odds
            continue
        # compared with the rest of the words that the shorter entry covers
        t, c = table[above]
        rest = (t - toxic + 0.5) / (t - toxic + c - clean + 1.0)
        if evidence(toxic, clean, min(max(rest, 1e-6), 1 - 1e-6)) >= EVIDENCE:
            weights[entry] = odds if odds >= ODDS else 0.0
    return weights


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(of, label, word): the distinct words of each text; ``of`` is the least hash among them."""
    for part in bounded_slices(batches):
        of, labels, found = [], [], []
        for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            words = sorted(set(folded_words(text)))
            if words:
                of += [signature(words)] * len(words)
                labels += [label] * len(words)
                found += words
        yield _columns(of=pa.array(of, pa.int64()), label=pa.array(labels, pa.int32()), word=pa.array(found, pa.string()))


def _columns(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def signature(words: list[str]) -> int:
    """The least hash of the words: near copies mostly share it."""
    return min(xxhash.xxh64_intdigest(w, 11) for w in words) >> 1


def _entry_counts(sample: DataFrame) -> DataFrame:
    """(entry, toxic, clean): distinct texts that hold a word of the entry."""
    words = sample.mapInArrow(_word_rows, "of long, label int, word string")
    words = words.where(~_for_curve(F.col("of"))).groupBy("of", "word").agg(F.max("label").alias("label"))
    by_word = words.groupBy("word").agg(
        F.sum("label").cast("long").alias("toxic"), F.sum(1 - F.col("label")).cast("long").alias("clean")
    )
    reach = F.least(F.length("word"), F.lit(MOST))
    starts = F.transform(F.sequence(F.lit(LEAST), F.greatest(reach, F.lit(LEAST))), lambda k: F.substring("word", F.lit(1), k))
    starts = F.when(F.length("word") >= LEAST, F.transform(starts, lambda s: F.concat(F.lit(OPEN), s)))
    whole = F.concat(F.lit(OPEN), "word", F.lit(CLOSE))
    entries = F.array_append(F.coalesce(starts, F.array().cast("array<string>")), whole)
    counted = by_word.select(F.explode(entries).alias("entry"), "toxic", "clean")
    return counted.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _for_curve(of: Column) -> Column:
    """Whether a text is kept from the lexicon and used for the curve instead."""
    return F.pmod(F.xxhash64(of), F.lit(4)) == 3


def toxic_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(text, label) of about ``rows`` documents whose toxic label may be learnt from.

    Taken by a hash of the id, at a rate from the exact number of usable labels, so that every
    run takes the same; the taken ids are broadcast, and that parameter bounds them. Of several
    labels of an id the greatest counts.
    """
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("label"))
        .where("doc_id is not null and label is not null")
        .where(~toxicity_held_out())
        .groupBy("doc_id")
        .agg((F.max("label") > 0).cast("int").alias("label"))
    )
    rate = min(1.0, rows / max(1, known.count()))
    taken = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < int(rate * (1 << 32)))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(taken), "doc_id").select("text", "label")


def toxicity_held_out(doc_id: str = "doc_id") -> Column:
    """Whether labels of this document are kept from learning; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_lexicon(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Lexicon:
    """The lexicon and its curve, from a bounded sample of labelled documents."""
    sample = toxic_sample(docs, labels, rows)
    counts = _entry_counts(sample).cache()
    try:
        # a whole word of every text, beside its beginnings, gives the share of toxic (text, word) pairs
        totals = counts.where(F.col("entry").endswith(CLOSE)).agg(F.sum("toxic"), F.sum("clean")).first()
        if not totals[0] or not totals[1]:
            return Lexicon()
        share = totals[0] / (totals[0] + totals[1])
        weights = chosen_entries(_worth_a_look(counts, share), share)
    finally:
        counts.unpersist()
    lexicon = Lexicon(weights)
    if weights:
        lexicon.weights |= _exceptions(sample, lexicon, share)
    n_words, weight, label = _curve_rows(sample, lexicon)
    if 0 < label.sum() < len(label):
        lexicon.curve = fitted_curve(_features(n_words, weight), label)
    else:
        lexicon.curve = (-3.0, 1.0, 1.0)  # too few texts to fit a curve: any weight counts
    return lexicon


def _worth_a_look(counts: DataFrame, share: float) -> list[tuple[str, int, int]]:
    """The clearest ``LEXICON`` toxic entries, and the longer entries below each of them."""
    n, t, c = F.col("toxic") + F.col("clean"), F.col("toxic"), F.col("clean")
    g = 2 * (
        F.when(t > 0, t * F.log(t / (n * share))).otherwise(0.0) + F.when(c > 0, c * F.log(c / (n * (1 - share)))).otherwise(0.0)
    )
    clear = counts.where((t > n * share) & (g >= EVIDENCE)).orderBy(F.desc(g), "entry").limit(LEXICON).collect()
    roots = {r.entry for r in clear}
    beginnings = sorted(e for e in roots if not e.endswith(CLOSE) and not any(e[:k] in roots for k in range(LEAST + 1, len(e))))
    if not beginnings:
        return [tuple(r) for r in clear]
    # no beginning is one of another, so an entry meets one of them at most
    tops = counts.sparkSession.createDataFrame([(b,) for b in beginnings], "top string")
    sizes = sorted({len(b) for b in beginnings})
    starts = F.array(*(F.substring("entry", 1, size) for size in sizes))
    below = counts.where(n >= 3).withColumn("top", F.explode(F.array_distinct(starts))).join(F.broadcast(tops), "top").drop("top")
    wanted = below.orderBy(F.desc(n), "entry").limit(4 * LEXICON).collect()
    return list({tuple(r) for r in wanted + [r for r in clear if r.entry.endswith(CLOSE)]})


def _exceptions(sample: DataFrame, lexicon: Lexicon, share: float) -> dict[str, float]:
    """Phrases of a matched word and a neighbour which toxic texts hold no more often than others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for part in bounded_slices(batches):
            of, labels, found = [], [], []
            for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = folded_words(text)
                ends = np.cumsum([len(w) + 2 for w in words])
                phrases = set()
                for end, _, weight in lexicon.matches(words, automaton):
                    if weight > 0:
                        i = int(np.searchsorted(ends, end, "right"))
                        phrases |= {marked(words[a : a + 2]) for a in (i - 1, i) if 0 <= a < len(words) - 1}
                if phrases:
                    of += [signature(words)] * len(phrases)
                    labels += [label] * len(phrases)
                    found += sorted(phrases)
            yield _columns(of=pa.array(of, pa.int64()), label=pa.array(labels, pa.int32()), phrase=pa.array(found, pa.string()))

    found = sample.mapInArrow(run, "of long, label int, phrase string").where(~_for_curve(F.col("of")))
    found = found.groupBy("of", "phrase").agg(F.max("label").alias("label")).groupBy("phrase")
    found = found.agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    # toxic at most as often as the sample's texts, and seen often enough to say so
    usual = found.where((F.col("clean") >= 3) & (F.col("toxic") <= share * (F.col("toxic") + F.col("clean"))))
    return {r.phrase: 0.0 for r in usual.orderBy(F.desc("clean"), "phrase").limit(LEXICON).collect()}


def _curve_rows(sample: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, matched weight and label of the texts kept from the lexicon, one for each signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for part in bounded_slices(batches):
            rows = []
            for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = folded_words(text)
                total = sum(w for _, _, w in lexicon.matches(words, automaton))
                rows.append((signature(words) if words else 0, len(words), float(total), label))
            of, n, weight, label = zip(*rows)
            yield _columns(of=pa.array(of), n=pa.array(n), weight=pa.array(weight), label=pa.array(label, pa.int32()))

    rows = sample.mapInArrow(run, "of long, n long, weight double, label int").where(_for_curve(F.col("of")))
    one_each = rows.groupBy("of").agg(F.max(F.struct("label", "weight", "n")).alias("row"))
    table = one_each.select("row.*").orderBy("n", "weight", "label").toPandas()
    return table["n"].to_numpy(float), table["weight"].to_numpy(float), table["label"].to_numpy(float)


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """A row per row of ``docs``: doc_id, held_out, score, predicted, n_words, n_hits."""
    lexicon = fit_lexicon(docs, labels, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded_slices(batches):
            n_words, n_hits, weight = lexicon.measured(part.column(2).to_pylist())
            score = lexicon.score(n_words, weight)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array(score),
                    pa.array((score >= threshold).astype(np.int32)),
                    pa.array(n_words.astype(np.int64)),
                    pa.array(n_hits.astype(np.int64)),
                ],
                ["doc_id", "held_out", "score", "predicted", "n_words", "n_hits"],
            )

    chosen = docs.select("doc_id", toxicity_held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int, n_words long, n_hits long"
    )
