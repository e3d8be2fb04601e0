"""A byte pair encoding of lower-cased words, with the ids of the ``tokenizers`` library.

The library's own normaliser and splitter take most of its time. White space ends every word, so a
text is cut at spaces and line ends, and what lies between is looked up; only what is new is
normalised and split here, by the rules in the tokenizer file, and its words go to the library's
model.
"""

from __future__ import annotations

import json
from array import array
from functools import lru_cache
from unicodedata import category, normalize

import regex
from tokenizers import Tokenizer

#: Longest stretch that is remembered, and how many stretches and words are.
_LONGEST, _STRETCHES, _WORDS = 48, 200_000, 500_000
#: Marks that end most stretches and are words of their own.
_MARKS = frozenset(".,;:!?")


class _Known(dict):
    """Ids of stretches without spaces, as machine words of 4 bytes."""

    def __init__(self, encode, most: int):
        self._encode, self._most = encode, most

    def __missing__(self, stretch: str) -> bytes:
        ids = self._encode(stretch)
        if len(stretch) <= _LONGEST and len(self) < self._most:
            self[stretch] = ids
        return ids


class WordCodec:
    """``model``: a tokenizer file that composes characters (NFC), joins white space, lower-cases,
    splits by one pattern and encodes the bytes of each word. Special tokens in a text are encoded as
    such. Another kind of file is refused."""

    def __init__(self, model: str):
        with open(model, encoding="utf-8") as file:
            spec = json.load(file)
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, spelled = spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or not split["invert"] or spelled["type"] != "ByteLevel":
            raise ValueError(f"{model} is not a tokenizer of lower-cased words")
        self._tokenizer = Tokenizer.from_file(model)
        self._model = self._tokenizer.model
        self._word = regex.compile(split["pattern"]["Regex"])
        self._special = {t["content"]: array("I", [t["id"]]).tobytes() for t in spec["added_tokens"]}
        self._cut = regex.compile("(" + "|".join(map(regex.escape, self._special)) + ")")
        # a byte is spelled as the character of its number if that is visible, else by one beyond 255
        visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        self._spelling = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in visible)}
        self._known = _Known(self._stretch, _STRETCHES)
        self._words = _Known(self._spelled, _WORDS)

    def _spelled(self, word: str) -> bytes:
        if not (word.isascii() and word.isprintable()):
            word = word.encode().decode("latin-1").translate(self._spelling)
        return array("I", [token.id for token in self._model.tokenize(word)]).tobytes()

    def _stretch(self, text: str) -> bytes:
        # lower case without regard to neighbours: a sigma that ends a word is like any other
        lower = text.lower() if text.isascii() else normalize("NFC", text).replace("Σ", "σ").lower()
        if lower.isalpha():
            return self._words[lower]
        if lower[-1:] in _MARKS and lower[:-1].isalpha():
            return self._words[lower[:-1]] + self._words[lower[-1]]
        if not text.isascii() and any(category(c) == "Cn" for c in text):
            # newer than the tables here: the library knows
            return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self._words.__getitem__, self._word.findall(lower)))

    def encode(self, text: str | None) -> bytes:
        """Ids as unsigned numbers of 4 bytes in the order of the machine; null has none."""
        parts = self._cut.split(text or "") if self._special else [text or ""]
        out = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(self._special[part])
            elif part:
                out += map(self._known.__getitem__, part.replace("\n", " ").split(" "))
        return b"".join(out)


@lru_cache(maxsize=4)
def word_codec(model: str) -> WordCodec:
    return WordCodec(model)
