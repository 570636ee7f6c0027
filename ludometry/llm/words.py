"""Words of many texts as integer arrays, so that tasks work on arrays and not on strings."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable

import numpy as np

# What ``re`` takes for word characters beside letters and decimal digits: other number signs.
_SIGNS = "".join(sign for sign in map(chr, range(sys.maxunicode + 1)) if sign.isnumeric() and not sign.isalpha() and not sign.isdecimal())
LETTERS = re.compile(rf"[^\W\d_{_SIGNS}]+")
# The same but for those signs, and several times as fast; hardly any text has one.
_RUNS = re.compile(r"[^\W\d_]+")


def letter_pattern(text: str) -> re.Pattern:
    """The faster pattern that finds the runs of letters of this text."""
    return _RUNS if "".join(_RUNS.findall(text)).isalpha() else LETTERS


def letter_runs(text: str) -> list[str]:
    """The maximal runs of letters."""
    found = _RUNS.findall(text)
    return found if "".join(found).isalpha() else LETTERS.findall(text)


class Numbering(dict):
    """Numbers for strings in order of appearance: a look-up adds what is missing."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int32, count=len(words))


class WordTable:
    """The different words of some texts, numbered in order of appearance."""

    def __init__(self, pattern: re.Pattern | None = None) -> None:
        self.find = letter_runs if pattern is None else pattern.findall
        self.index = Numbering()

    def ids(self, text: str) -> np.ndarray:
        return self.index.of(self.find(text))

    @property
    def words(self) -> list[str]:
        return list(self.index)


def gram_buckets(words: Iterable[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed pairs and triples of the characters of words, ends marked, and whole words.

    Returns buckets (a power of two) and, for each, the number of its word.
    """
    words = list(words)
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    joined = "".join(f"\x02{word}\x03" for word in words)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    owner = np.repeat(np.arange(len(words)), lengths)
    a, b, c = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
    pair = codes[:-1] * a + codes[1:] * b
    triple = pair[:-1] * c + codes[2:] * a + np.uint64(1)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(len(codes), dtype=np.uint64) - np.repeat(starts, lengths).astype(np.uint64)
    with np.errstate(over="ignore"):
        spread = (codes * a + np.uint64(7)) ^ ((place + np.uint64(1)) * b)
        spread ^= spread >> np.uint64(29)
        whole = np.add.reduceat(spread * c, starts)
    hashes = np.concatenate((pair[owner[:-1] == owner[1:]], triple[owner[:-2] == owner[2:]], whole))
    owners = np.concatenate((owner[:-1][owner[:-1] == owner[1:]], owner[:-2][owner[:-2] == owner[2:]], np.arange(len(words))))
    hashes ^= hashes >> np.uint64(31)
    hashes *= b
    hashes ^= hashes >> np.uint64(29)
    return (hashes & np.uint64(buckets - 1)).astype(np.int64), owners
