"""Counts over many whole texts at once: characters by kind, words, lines and repetitions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ridgeway.llm import wordhash
from ridgeway.llm.common import raw_bytes

KINDS = ("lower", "upper", "digit", "space", "bang", "bar", "symbol", "mark", "other", "lead", "tail")


def _kind(b: int) -> str:
    c = chr(b)
    if b >= 0x80:
        return "tail" if b < 0xC0 else "lead"
    if c.isalpha():
        return "lower" if c.islower() else "upper"
    if c.isdigit():
        return "digit"
    if wordhash.SPACES[b]:
        return "space"
    return {"!": "bang", "|": "bar"}.get(c) or ("symbol" if c in "#*$%&<>" else "mark" if c in ".,;:?'\"()-" else "other")


_KIND_OF = np.array([KINDS.index(_kind(b)) for b in range(256)])
_NOT_SPACE = ~wordhash.SPACES
_NOT_BREAK = np.arange(256) != 10


def _seen_before(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per entry: whether its owner has the value earlier, and whether it has it more than once."""
    key = wordhash.mixed(value ^ wordhash.mixed(owner.astype(np.uint64)))
    _, first, which, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    return first[which] != np.arange(len(key)), n[which] > 1


class TextStats:
    """Statistics of the texts of an Arrow array; a null text is empty."""

    def __init__(self, texts: pa.Array) -> None:
        self.data, self.bounds = raw_bytes(texts)
        self.n = len(texts)
        counts = np.zeros(self.n * len(KINDS), np.int64)
        for a in range(0, len(self.data), wordhash.STEP):
            part = self.data[a : a + wordhash.STEP]
            sizes = np.diff(np.clip(self.bounds, a, a + len(part)))
            owner = np.repeat(np.arange(self.n) * len(KINDS), sizes)
            counts += np.bincount(owner + _KIND_OF[part], minlength=len(counts))
        self.kinds = dict(zip(KINDS, counts.reshape(self.n, len(KINDS)).T))
        self.starts, self.ends, self.owner = wordhash.spans(self.data, self.bounds, _NOT_SPACE)
        self.words = wordhash.hashes(self.data, self.starts, self.ends)
        self.n_words = self._per_text(self.owner)

    def _per_text(self, owner: np.ndarray) -> np.ndarray:
        return np.bincount(owner, minlength=self.n)

    def repeated_lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Per text: lines with a word that equal an earlier line, and lines with a word."""
        starts, ends, owner = wordhash.spans(self.data, self.bounds, _NOT_BREAK)
        words_before = np.searchsorted(self.starts, starts)
        full = np.searchsorted(self.starts, ends) > words_before
        starts, ends, owner = starts[full], ends[full], owner[full]
        again, _ = _seen_before(owner, wordhash.hashes(self.data, starts, ends))
        return self._per_text(owner[again]), self._per_text(owner)

    def words_in_repeats(self, window: int = 3) -> np.ndarray:
        """Per text: words that lie in a window of words found at least twice in the text."""
        gram = wordhash.grams(self.words, window)
        n = len(gram)
        whole = np.flatnonzero(self.owner[:n] == self.owner[window - 1 :][:n])
        _, twice = _seen_before(self.owner[whole], gram[whole])
        inside = np.zeros(len(self.words), bool)
        for j in range(window):
            inside[whole[twice] + j] = True
        return self._per_text(self.owner[inside])

    def distinct_words(self) -> np.ndarray:
        again, _ = _seen_before(self.owner, self.words)
        return self._per_text(self.owner[~again])

    def word_after_itself(self) -> np.ndarray:
        """Per text: words equal to the word before them."""
        same = (self.words[1:] == self.words[:-1]) & (self.owner[1:] == self.owner[:-1])
        return self._per_text(self.owner[1:][same])
