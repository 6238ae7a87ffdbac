"""Splitting text into the words of a public tokenizer, and encoding each distinct word once.

A word's ids don't depend on its neighbours, so a text's ids are its words' ids in order. Texts made of the letters,
digits and marks below U+023A and common punctuation are split by a pattern built here from Unicode categories;
any other text is split by the tokenizer library itself. Tests hold both against the library's own encode().
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from functools import cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Longer words are encoded each time instead of being kept.
KEEP_CHARS, KEEP_WORDS = 64, 600_000


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _class(kind: str) -> str:
    found = [c for c in range(0x2B0) if unicodedata.category(chr(c))[0] == kind]
    return "".join(f"\\u{c:04x}" for c in found)


LETTER, NUMBER = _class("L"), _class("N")
SPACE = r"\t-\r\x20\x85\xa0"
#: Outside of this the library splits: other scripts, control characters, and U+0130, whose small form has two characters.
UNUSUAL = re.compile(r"[^\t-\r\x20-\x7e\x85\xa0-įı-ȹ‐-‧‰-⁞€]")


def _byte_spelling() -> dict[int, str]:
    """Byte -> character: printable Latin-1 characters stand for themselves, the others, in order, for U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


BYTE_SPELLING = _byte_spelling()


@cache
def load(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


class ByteLevelWords:
    """Words as the byte-level pre-tokenizer makes them; ids of a text as packed integers."""

    PATTERN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")

    def __init__(self, path: str, dtype: str):
        self.tok, self.dtype = load(path), dtype
        self.model, self.code = self.tok.model, {"<u2": "H", "<u4": "I"}[dtype]
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        words = self

        class Known(dict):
            def __missing__(self, word):
                # a word of this pattern needs the model alone, in the vocabulary's spelling of bytes
                spelt = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(BYTE_SPELLING)
                ids = array(words.code, [t.id for t in words.model.tokenize(spelt)]).tobytes()
                if len(word) <= KEEP_CHARS:
                    if len(self) >= KEEP_WORDS:
                        self.clear()
                    self[word] = ids
                return ids

        self.known = Known()

    def _ids(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        if UNUSUAL.search(text) or any(s in text for s in self.special):
            return self._ids(text)
        return b"".join(map(self.known.__getitem__, self.PATTERN.findall(text)))


@cache
def byte_level_words(path: str, dtype: str) -> ByteLevelWords:
    """One for all tasks of a Python worker, so that words known from earlier tasks stay known."""
    return ByteLevelWords(path, dtype)


class CaselessWords:
    """Words of the tokenizer that lower-cases, drops white space and marks word ends."""

    PATTERN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+")

    def __init__(self, path: str):
        self.tok = load(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def split(self, text: str) -> list[str]:
        if UNUSUAL.search(text) or any(s in text for s in self.special):
            out: list[str] = []
            for part in self.cut.split(text) if self.cut else [text]:
                if part in self.special:
                    out.append(part)
                elif part:
                    norm = self.tok.normalizer.normalize_str(part)
                    out += [norm[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(norm)]
            return out
        return self.PATTERN.findall(text.lower())

    def encode_words(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch(words, add_special_tokens=False)]

    def pieces(self) -> list[str]:
        """id -> piece, bounded by the vocabulary."""
        by_id = {i: p for p, i in self.tok.get_vocab(with_added_tokens=True).items()}
        return [by_id.get(i, "") for i in range(max(by_id) + 1)]
