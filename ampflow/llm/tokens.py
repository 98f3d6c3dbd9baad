"""Words of a tokenizer file: its normalisation, special strings and split, read from the file's own settings.

Covers BPE files with byte-level symbols and a word-end suffix. Words are the units no merge crosses, so they can be
encoded apart, and each distinct word once. Letters are those of this Python's Unicode tables (15.1); the few that later
editions added split as other symbols do.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cached_property

from ampflow.llm.common import worker_cache

#: Characters whose normalisation and class Python's faster ``re`` gets right; other texts take the general path.
UNCOMMON = re.compile("[^\t\n\r -~À-ÖØ-öø-ÿ]")
COMMON_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
#: The split pattern of the file, and the white space it means (the Unicode property).
SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


#: Words that a worker remembers: the first ones, among which are the frequent ones. Some 40 MB, as long ones are not kept.
REMEMBERED = 150_000
LONGEST = 64


class Remembered(dict):
    """Results by key, computed on first use and kept for the first keys that are not long; others are computed each time."""

    def __init__(self, compute, limit: int = REMEMBERED):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) < self.limit and len(key) <= LONGEST:
            self[key] = value
        return value


def _class(first: str) -> str:
    """Ranges of the characters whose general category begins with ``first``, for a bracketed set."""
    codes = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == first]
    starts = [c for i, c in enumerate(codes) if i == 0 or codes[i - 1] != c - 1]
    ends = [c for i, c in enumerate(codes) if i + 1 == len(codes) or codes[i + 1] != c + 1]
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in zip(starts, ends, strict=True))


def _general_words() -> re.Pattern:
    letters, numbers = _class("L"), _class("N")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{SPACE}{letters}{numbers}]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if visible in Latin-1, else the next from U+0100."""
    visible = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


class TokenizerFile:
    """Vocabulary, merges and word split of one file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        steps = [n["type"] for n in content["normalizer"]["normalizers"]]
        split = content["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if steps != ["NFC", "Replace", "Lowercase"] or split != SPLIT_PATTERN or content["decoder"] is not None:
            raise ValueError(f"{path} normalises, splits or decodes in a way that is not covered")
        self.path = path
        self.suffix: str = model["end_of_word_suffix"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.symbols = byte_symbols()

    @cached_property
    def special_pattern(self) -> re.Pattern:
        return re.compile("|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) or "(?!)")

    @cached_property
    def tokens(self) -> list[str]:
        """Token strings by id."""
        both = self.vocabulary | self.special
        out = [""] * (max(both.values()) + 1)
        for token, number in both.items():
            out[number] = token
        return out

    def parts(self, text: str) -> Iterator[tuple[bool, str]]:
        """``(is special, string)`` pieces of a text in order."""
        at = 0
        for found in self.special_pattern.finditer(text):
            if found.start() > at:
                yield False, text[at : found.start()]
            yield True, found.group()
            at = found.end()
        if at < len(text):
            yield False, text[at:]

    @staticmethod
    def words(text: str) -> list[str]:
        """Normalised words of a text without special strings."""
        if UNCOMMON.search(text) is None:
            return COMMON_WORDS.findall(text.lower())
        pattern = worker_cache("general-words", _general_words)  # built when a worker meets its first uncommon text
        composed = unicodedata.normalize("NFC", text)
        # Lower case is taken character by character: a final sigma is no other letter here.
        return pattern.findall("σ".join(part.lower() for part in composed.split("Σ")))
