"""Byte-level BPE by pre-token: what the tokenizers library gives, looked up word by word.

A byte-level BPE splits a text into pre-tokens and merges inside each of them only, so the tokens of
a text are those of its pre-tokens in order.  ``splitter`` cuts a text as the library does, and
``Pieces`` encodes single pre-tokens with the library's own model, so a task can keep the results of
pre-tokens it has met.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import regex
from tokenizers import Tokenizer

#: Split pattern of the byte-level pre-tokenizer (fixed value).
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Letters and numbers of the first 256 code points, where ``re`` does the same work faster.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿªµº"
_NUMBER = "0-9²³¹¼-¾"
_LATIN_PATTERN = (
    rf" ?[{_LETTER}]+|'(?:[stmd]|re|ve|ll)| ?[{_NUMBER}]+|"
    rf" ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+"
)
#: White space of ``re`` that is none to the pre-tokenizer: such texts take the exact pattern.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_BEYOND_LATIN = re.compile("[^\x00-\xff]")

#: Pre-tokens longer than this are encoded afresh each time.
LONGEST_KEPT = 64


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, once per Python process."""
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _exact_pattern():
    return regex.compile(BYTE_LEVEL_PATTERN)


@lru_cache(maxsize=2)
def _latin_pattern():
    return re.compile(_LATIN_PATTERN)


@lru_cache(maxsize=2)
def added_tokens(path: str) -> dict[str, int]:
    """Strings that the library takes out of a text before splitting it, with their ids."""
    settings = json.loads(tokenizer(path).to_str())
    if settings["normalizer"] is not None or settings["model"]["type"] != "BPE":
        raise ValueError(f"{path} is not a plain byte-level BPE")
    added = settings["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError(f"{path} has added tokens that are not plain strings")
    return {t["content"]: t["id"] for t in added}


def split(text: str) -> list[str]:
    """The pre-tokens of a text without added tokens."""
    if _BEYOND_LATIN.search(text) or _SEPARATORS.search(text):
        return _exact_pattern().findall(text)
    return _latin_pattern().findall(text)


def splitter(path: str):
    """A function from a text to its pre-tokens, added tokens among them as they are."""
    added = added_tokens(path)
    if not added:
        return split
    between = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

    def pieces(text: str) -> list[str]:
        if not any(token in text for token in added):
            return split(text)
        parts = between.split(text)
        return [p for i, part in enumerate(parts) for p in ([part] if i % 2 else split(part))]

    return pieces


@lru_cache(maxsize=1)
def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones themselves,
    the rest in order from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for byte in range(256):
        if byte in shown:
            letters.append(chr(byte))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


class Pieces(dict):
    """Value by pre-token; what is missing is encoded by the library's model and kept.

    ``value`` makes the kept value of a list of ids.  When ``most`` pre-tokens are kept beside the
    ``fixed`` ones they become the old generation, from which those still in use come back; the
    generation before is forgotten.  So a worker's memory stays bounded whatever the texts hold.
    """

    def __init__(self, path: str, value, most: int = 350_000, fixed: dict | None = None):
        self._model = tokenizer(path).model
        self._letters = dict(enumerate(_byte_letters()))
        self._value = value
        self._fixed = (fixed or {}) | {token: value([i]) for token, i in added_tokens(path).items()}
        self._full = most + len(self._fixed)
        self._old: dict = {}
        super().__init__(self._fixed)

    def __missing__(self, piece: str):
        value = self._old.get(piece)
        if value is None:
            if piece.isascii() and piece.isprintable():
                coded = piece.replace(" ", self._letters[32])
            else:
                coded = piece.encode().decode("latin-1").translate(self._letters)
            value = self._value([token.id for token in self._model.tokenize(coded)])
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= self._full:
                self._old = dict(self)
                self.clear()
                self.update(self._fixed)
            self[piece] = value
        return value
