"""Language of documents and of the spans inside mixed ones.

Word scores: log-probabilities of the word's hashed byte n-grams (orders 3 and 4, with
the white space around the word), relative to the mean over languages. Script ranges
narrow the candidates: a language that does not use any script of a word's letters
cannot label that word, unless no language does. Viterbi with a penalty for each change
of language then labels the words of the text; runs of equal labels are its spans. The
text's language is the one with most letters (ties: first by name), its score the share
of the letters.

Viterbi works on all texts of an Arrow slice at once: texts are cut into blocks of
``BLOCK`` words; for every block the best path from each language before it to each at
its end is found; the blocks of a text are chained; and with the languages at the block
ends known, the blocks are labelled. That is the exact best path, in few vector steps
also for very long texts.

The model is fitted on about ``FIT_ROWS`` documents per language, taken by hash at a rate
from exact counts, of those whose crc32(doc_id) mod 4 is not 2 and whose lang is not
null. lang, source and doc_id are not inputs of a prediction.

Defined cases: a null text or one without a letter is ``und`` with score 0 and no spans;
without any row to learn from all are ``und``; repeated rows are labelled each; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.llm import wordhash
from ridgeway.llm.common import Shared, bounded_slices, held_out, raw_bytes

FIT_ROWS = 3_000
ORDERS = (3, 4)
SLOT_BITS = 16
SLOTS = 1 << SLOT_BITS
SMOOTH = 0.1
#: Log-odds that a change of language costs.
SWITCH = 8.0
#: Log-odds against a language that does not use a word's script.
FOREIGN = 1e4
#: A language uses a script that has this share of its letters.
LEAST_SHARE = 0.005
BLOCK = 64
#: Words whose n-grams are looked up at once.
WORDS = 100_000

#: First code points of script ranges of the Unicode standard, in order, and the script.
SCRIPTS = (
    (0x0000, "none"), (0x0041, "latin"), (0x005B, "none"), (0x0061, "latin"), (0x007B, "none"),
    (0x00AA, "latin"), (0x00AB, "none"), (0x00BA, "latin"), (0x00BB, "none"), (0x00C0, "latin"),
    (0x0250, "none"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "none"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "none"),
    (0x0E00, "thai"), (0x0E80, "none"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "none"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "none"), (0x3040, "kana"), (0x3100, "none"),
    (0x3400, "han"), (0xA000, "none"), (0xAC00, "hangul"), (0xD7B0, "none"), (0xF900, "han"),
    (0xFB00, "none"), (0x20000, "han"), (0x30000, "none"),
)
_FROM = np.array([a for a, _ in SCRIPTS])
_NAMES = sorted({s for _, s in SCRIPTS} - {"none"})
_SCRIPT = np.array([_NAMES.index(s) if s != "none" else -1 for _, s in SCRIPTS])
_ASCII_LETTER = np.array([chr(b).isalpha() and b < 0x80 for b in range(256)])
_PLAIN = np.where(wordhash.SPACES, 32, wordhash.LOWER).astype(np.uint8)


class Words:
    """The words of some texts: n-gram slots, letters and scripts."""

    def __init__(self, texts: pa.Array) -> None:
        data, bounds = raw_bytes(texts)
        self.n = len(texts)
        self.starts, self.ends, self.owner = wordhash.spans(data, bounds, ~wordhash.SPACES)
        self.data = data
        self.scripts = np.zeros(len(self.starts), np.int64)
        self.letters = np.zeros(len(self.starts), np.int64)
        letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data], dtype=np.int64)])
        self.letters = letters[self.ends] - letters[self.starts]
        latin = _NAMES.index("latin")
        self.scripts[self.letters > 0] |= 1 << latin
        self.by_script = {latin: np.bincount(self.owner, self.letters, self.n)}
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            b = [data[np.minimum(lead + k, len(data) - 1)].astype(np.int64) & 0x3F for k in range(4)]
            first = data[lead].astype(np.int64)
            two, three = (first & 0x1F) << 6 | b[1], (first & 0x0F) << 12 | b[1] << 6 | b[2]
            four = (first & 0x07) << 18 | b[1] << 12 | b[2] << 6 | b[3]
            point = np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))
            script = _SCRIPT[np.searchsorted(_FROM, point, "right") - 1]
            word = np.searchsorted(self.starts, lead, "right") - 1
            word, script = word[script >= 0], script[script >= 0]
            np.bitwise_or.at(self.scripts, word, 1 << script)
            self.letters += np.bincount(word, minlength=len(self.starts))
            for s in np.unique(script).tolist():
                here = np.bincount(self.owner[word[script == s]], minlength=self.n)
                self.by_script[s] = self.by_script.get(s, 0) + here

    def slots(self) -> Iterator[tuple[slice, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]]:
        """Per stretch of words and order: slots, and where each word's begin and end."""
        for at in range(0, len(self.starts), WORDS):
            words = slice(at, min(at + WORDS, len(self.starts)))
            starts, ends = self.starts[words], self.ends[words]
            # a blank goes in before each word; what lies between words is left out
            sizes = ends - starts
            first = np.concatenate([[0], np.cumsum(sizes + 1)])
            padded = np.full(int(first[-1]) + max(ORDERS), 32, np.uint8)
            inside = np.ones(int(first[-1]), bool)
            inside[first[:-1]] = False
            source = np.arange(int(sizes.sum())) + np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
            padded[: len(inside)][inside] = _PLAIN[self.data[source]]
            del source
            wide = padded.astype(np.uint32)
            found = []
            for order in ORDERS:
                code = np.zeros(len(wide) - order + 1, np.uint32)
                for k in range(order):
                    code = (code + wide[k : k + len(code)]) * np.uint32(0x01000193)
                slot = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)).astype(np.int64)
                # from the blank before the word to the blank after it
                found.append((slot, first[:-1], np.maximum(first[:-1], first[1:] + 2 - order)))
            yield words, found


@dataclass
class LanguageModel:
    languages: list[str]
    tables: np.ndarray  # order, slot, language
    uses: np.ndarray  # language, script

    def word_scores(self, words: Words) -> np.ndarray:
        out = np.zeros((len(words.starts), len(self.languages)))
        for part, orders in words.slots():
            for table, (slot, first, last) in zip(self.tables, orders):
                for k in range(len(self.languages)):
                    sums = np.concatenate([[0.0], np.cumsum(table[slot, k])])
                    out[part, k] += sums[last] - sums[first]
        used = words.scripts[:, None] & (self.uses << np.arange(self.uses.shape[1])).sum(1)[None, :] != 0
        out -= FOREIGN * (~used & used.any(1)[:, None])
        return out

    def labels(self, words: Words) -> np.ndarray:
        """The language number of every word."""
        counts = np.bincount(words.owner, minlength=words.n)
        return viterbi(self.word_scores(words), counts, SWITCH)


def _step(v: np.ndarray, scores: np.ndarray, penalty: float) -> np.ndarray:
    """Best totals after one more word; the last axis of ``v`` is the language."""
    return np.maximum(v, v.max(-1, keepdims=True) - penalty) + scores


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word: rows of ``scores`` lie text after text, ``counts`` each.

    Ties go to no change, then to the lower label.
    """
    n, k = scores.shape
    if not n:
        return np.zeros(0, np.int64)
    per_text = -(-counts // BLOCK)
    text = np.repeat(np.arange(len(counts)), per_text)
    first_block = np.concatenate([[0], np.cumsum(per_text)])
    nth = np.arange(len(text)) - first_block[text]
    start = np.concatenate([[0], np.cumsum(counts)])[text] + nth * BLOCK
    size = np.minimum(BLOCK, counts[text] - nth * BLOCK)
    order = np.argsort(-size, kind="stable")
    active = np.searchsorted(-size[order], -np.arange(1, BLOCK + 1), "right")
    # from each language before a block to each at its end
    far = np.where(np.eye(k, dtype=bool), 0.0, -np.inf)
    paths = np.repeat(far[None], len(text), 0)
    for t, m in enumerate(active):
        if m:
            rows = order[:m]
            paths[rows] = _step(paths[rows], scores[start[rows] + t][:, None, :], penalty)
    # chain the blocks of each text
    by_length = np.argsort(-per_text, kind="stable")
    running = np.searchsorted(-per_text[by_length], -np.arange(1, per_text.max() + 1), "right")
    total = np.zeros((len(counts), k))
    came = np.zeros((len(text), k), np.int64)
    for b, m in enumerate(running):
        texts = by_length[:m]
        block = first_block[texts] + b
        options = total[texts][:, :, None] + paths[block]
        came[block] = options.argmax(1)
        total[texts] = options.max(1)
    before = np.zeros(len(text), np.int64)
    after = np.zeros(len(text), np.int64)
    now = total.argmax(1)
    for b in range(len(running) - 1, -1, -1):
        texts = by_length[: running[b]]
        block = first_block[texts] + b
        after[block] = now[texts]
        before[block] = came[block, now[texts]]
        now[texts] = before[block]
    # label each block between its known ends
    best = np.full((len(text), k), -np.inf)
    best[np.arange(len(text)), before] = 0.0
    source = np.zeros((n, k), np.int8 if k < 128 else np.int32)
    for t, m in enumerate(active):
        if m:
            rows = order[:m]
            v = best[rows]
            top = v.argmax(1)
            change = v.max(1, keepdims=True) - penalty > v
            source[start[rows] + t] = np.where(change, top[:, None], np.arange(k)[None, :])
            best[rows] = _step(v, scores[start[rows] + t], penalty)
    label = np.zeros(n, np.int64)
    now = after.copy()
    for t in range(BLOCK - 1, -1, -1):
        rows = order[: active[t]]
        if len(rows):
            at = start[rows] + t
            label[at] = now[rows]
            now[rows] = source[at, now[rows]]
    return label


def fit_languages(docs: DataFrame, rows: int = FIT_ROWS, lang: str = "lang") -> LanguageModel | None:
    """The model of the rows that may be learnt from; None without any."""
    known = docs.select(
        F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col(lang).cast("string").alias("lang")
    ).where("lang is not null and text is not null").where(~held_out())
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    rate = F.create_map(*[x for name in languages for x in (F.lit(name), F.lit(min(1.0, rows / counts[name])))])
    # by content alone: the same documents in other files, or read again, give the same sample
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 32)) / float(1 << 32)
    sample = known.withColumn("draw", draw).where(F.col("draw") < rate[F.col("lang")]).select("text", "lang")
    n_slots = len(ORDERS) * SLOTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for part in bounded_slices(batches):
            names = np.array(part.column(1).to_pylist(), object)
            for name in np.unique(names):
                count = seen.setdefault(name, np.zeros(n_slots + len(_NAMES), np.int64))
                words = Words(part.column(0).filter(pa.array(names == name)))
                for _, orders in words.slots():
                    for i, (slot, first, last) in enumerate(orders):
                        sizes = last - first
                        at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                        count[i * SLOTS : (i + 1) * SLOTS] += np.bincount(slot[at], minlength=SLOTS)
                for script, letters in words.by_script.items():
                    count[n_slots + script] += int(np.sum(letters))
        for name, count in seen.items():
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(count[used])],
                ["lang", "slot", "n"],
            )

    counted = sample.mapInArrow(run, "lang string, slot int, n long")
    table = counted.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()  # at most all slots per language
    place = {name: i for i, name in enumerate(languages)}
    which = np.array([place[v] for v in table["lang"].to_pylist()], np.int64)
    full = np.zeros((len(languages), n_slots + len(_NAMES)))
    full[which, table["slot"].to_numpy()] = table["n"].to_numpy()
    grams = full[:, :n_slots].reshape(len(languages), len(ORDERS), SLOTS)
    logs = np.log((grams + SMOOTH) / (grams.sum(2, keepdims=True) + SMOOTH * SLOTS))
    letters = full[:, n_slots:]
    uses = letters >= LEAST_SHARE * np.maximum(letters.sum(1, keepdims=True), 1)
    return LanguageModel(languages, (logs - logs.mean(0)).transpose(1, 2, 0).copy(), uses.astype(np.int64))


SPAN = pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("words", pa.int64())])


def languages(docs: DataFrame, rows: int = FIT_ROWS, lang: str = "lang") -> DataFrame:
    """A row per row of ``docs``: doc_id, held_out, lang_pred, score, spans (lang, first_word, words)."""
    model = Shared(docs.sparkSession, fit_languages(docs, rows, lang))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt: LanguageModel | None = model.value
        for part in bounded_slices(batches):
            n = part.num_rows
            names, score = np.full(n, "und", object), np.zeros(n)
            spans: list[list[dict]] = [[] for _ in range(n)]
            if learnt:
                words = Words(part.column(2))
                label = learnt.labels(words)
                k = len(learnt.languages)
                share = np.bincount(words.owner * k + label, words.letters, n * k).reshape(n, k)
                total = share.sum(1)
                unsure = np.flatnonzero((total == 0) & (np.bincount(words.owner, minlength=n) > 0))
                for i in unsure.tolist():  # letters of scripts without a range count alike
                    if any(c.isalpha() for c in part.column(2)[i].as_py()):
                        share[i] = np.bincount(label[words.owner == i], minlength=k)
                        total[i] = share[i].sum()
                some = total > 0
                best = share.argmax(1)
                names[some] = np.array(learnt.languages, object)[best[some]]
                score[some] = share[np.arange(n), best][some] / total[some]
                new = np.flatnonzero((np.diff(words.owner, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))
                first = np.concatenate([[0], np.cumsum(np.bincount(words.owner, minlength=n))])
                sizes = np.diff(np.append(new, len(label)))
                for at, size in zip(new.tolist(), sizes.tolist()):
                    i = int(words.owner[at])
                    if some[i]:
                        spans[i].append({"lang": learnt.languages[label[at]], "first_word": at - int(first[i]), "words": size})
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(score), pa.array(spans, pa.list_(SPAN))],
                ["doc_id", "held_out", "lang_pred", "score", "spans"],
            )

    chosen = docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(
        run,
        f"doc_id {kind}, held_out boolean, lang_pred string, score double, "
        "spans array<struct<lang:string,first_word:bigint,words:bigint>>",
    )
