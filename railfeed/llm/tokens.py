"""Token ids of whole texts by a public tokenizer, encoded once per distinct word."""

from __future__ import annotations

import os
import re
import unicodedata

import numpy as np

_SIGNS = ".,!?;:|*#$%&"
_LATIN = re.compile(r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_SHARED: dict[tuple, "WordEncoder"] = {}


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte: itself, or the next free one from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Ids of a text, equal to encoding it whole, as packed little-endian 32-bit integers.

    Both vocabularies split a text before they merge bytes, and a single space between two words is always such a
    split, as is the place between letters and a tail of signs. So words are encoded once and looked up after that;
    plain words go straight to the tokenizer's merges. A text for which that reasoning does not hold (runs of white
    space in the byte vocabulary, strings of added tokens) is encoded whole.
    """

    def __init__(self, path: str, spaces: bool, keep: int = 100_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merge, self.letters = self.tokenizer.model.tokenize, _byte_letters()
        self.spaces, self.keep = spaces, keep
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.known: dict[str, bytes] = {"": b""}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _pieces(self, text: str) -> list[str] | None:
        low = text.lower()
        if any(content in low for content in self.added):
            return None  # such a string is an id of its own, but not in other letters, which a word would lose
        if not self.spaces:
            if "\u03a3" in text or "\u0130" in text or not unicodedata.is_normalized("NFC", text):
                return None  # two letters have rules of their own for lower case
            return low.replace("\n", " ").split(" ")
        if "\0" in text or " ".join(text.split()) != text.replace("\n", " "):
            return None
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def _learn(self, pieces: list[str]) -> None:
        if len(self.known) > self.keep:
            self.known = {"": b""}
        known, packed, merge, space = self.known, self.packed, self.merge, self.letters[32]
        for word in set(pieces).difference(known):
            core = word.rstrip(_SIGNS)
            if core.isascii() and (core.isalpha() or core[:1] == " " and core[1:].isalpha()):
                shown = core.replace(" ", space)
            elif _LATIN.fullmatch(core):
                shown = core.encode().decode("latin-1").translate(self.letters)
            else:
                known[word] = self.whole(word)
                continue
            raw = known.get(core)
            if raw is None:
                raw = known[core] = b"".join([packed[t.id] for t in merge(shown)])
            if len(core) < len(word):
                tail = word[len(core) :]
                if tail not in known:
                    known[tail] = self.whole(tail)
                known[word] = raw + known[tail]

    def encode(self, text: str) -> bytes:
        pieces = self._pieces(text)
        if pieces is None:
            return self.whole(text)
        try:
            return b"".join(map(self.known.__getitem__, pieces))
        except KeyError:
            self._learn(pieces)
        return b"".join(map(self.known.__getitem__, pieces))


def encoder(path: str, spaces: bool, keep: int = 100_000) -> WordEncoder:
    """One per Python worker and vocabulary, so that later tasks know the words of earlier ones; it holds ``keep`` words."""
    if (path, spaces, keep) not in _SHARED:
        _SHARED[path, spaces, keep] = WordEncoder(path, spaces, keep)
    return _SHARED[path, spaces, keep]
