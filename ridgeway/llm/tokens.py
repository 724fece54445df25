"""Token ids of whole texts, each distinct word encoded once per worker and cache filling."""

from __future__ import annotations

import re
import struct

from tokenizers import Tokenizer

#: Words that a worker remembers; the memory is emptied when it is full.
REMEMBERED = 400_000
#: Longer stretches without a space are encoded each time.
LONGEST = 64

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIMPLE = re.compile(f"([{_LETTERS}]+)([.,;:!?*#$%&|<>()-]*)")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write byte b as this letter: itself if visible, else from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordEncoder:
    """Ids of a text as little-endian unsigned 32-bit numbers.

    For tokenizers that drop white space, so that no token crosses it: a text is cut at
    spaces and line ends, and each part is encoded on its own. Parts that are letters of
    ASCII or Latin-1 and then punctuation go to the vocabulary's model directly where the
    tokenizer lower-cases and splits letters from other signs (``plain_words``); all other
    parts go through the whole tokenizer.
    """

    def __init__(self, definition: str, plain_words: bool = True) -> None:
        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.plain_words = plain_words
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {"": b""}
        self.cores: dict[str, bytes] = {}

    def _whole(self, part: str) -> bytes:
        return _packed(self.tokenizer.encode(part, add_special_tokens=False).ids)

    def _core(self, core: str) -> bytes:
        ids = self.cores.get(core)
        if ids is None:
            spelled = core if core.isascii() else core.encode().decode("latin-1").translate(self.letters)
            ids = self.cores[core] = _packed([t.id for t in self.model.tokenize(spelled)])
        return ids

    def _encode(self, part: str) -> bytes:
        if len(part) > LONGEST:
            return self._whole(part)
        simple = _SIMPLE.fullmatch(part) if self.plain_words else None
        if simple:
            core, signs = simple.groups()
            ids = self._core(core.lower())
            if signs:
                tail = self.words.get(signs)
                ids += self._encode(signs) if tail is None else tail
        else:
            ids = self._whole(part)
        self.words[part] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if len(self.words) > REMEMBERED:
            self.words, self.cores = {"": b""}, {}
        parts = text.replace("\n", " ").split(" ")
        found = list(map(self.words.get, parts))
        if None in found:  # parts that aren't known yet
            encode, known = self._encode, self.words.get
            for i, ids in enumerate(found):
                if ids is None:
                    part = parts[i]
                    ids = known(part)  # it may have come up since
                    found[i] = encode(part) if ids is None else ids
        return b"".join(found)
