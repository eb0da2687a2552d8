"""Words of texts in numpy arrays, and per-word values summed by text.

A word is a run of letters, lower-cased.  Models here give every word a row of
numbers (costs per language, a toxicity weight), and a text the sum over its
words.  New words of a batch are valued together by a vectorised function; a
cache of bounded size remembers them.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import xxhash

CACHE_WORDS = 300_000
_RUN = re.compile(r"[^\W\d_]+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    """Runs of letters, lower-cased (null: none).  Numeral signs that are not letters are left out."""
    if not text:
        return []
    found = _RUN.findall(text.lower())
    if text.isascii():
        return found
    return [w for w in ("".join(c for c in w if c.isalpha()) if not w.isalpha() else w for w in found) if w]


def flat(items: list[str], head: str, tail: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, word number, position in its word) of head + word + tail for all words."""
    size = np.array([len(w) + len(head) + len(tail) for w in items], dtype=np.int64)
    joined = "".join([head + w + tail for w in items])
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    start = np.cumsum(size) - size
    return code, np.repeat(np.arange(len(items)), size), np.arange(len(code)) - np.repeat(start, size)


def gram_hashes(code: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n characters that end at each position (the first n - 1 positions: of fewer)."""
    out = np.zeros(len(code), dtype=np.uint64)
    for back in range(n - 1, -1, -1):
        out *= MULTIPLIER
        if back < len(code):
            out[back:] += code[:len(code) - back]
    out ^= out >> np.uint64(31)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


class WordSums:
    """Sums of per-word rows.  ``value(words)`` gives an array (len(words), width)."""

    def __init__(self, value: Callable[[list[str]], np.ndarray], width: int):
        self._value = value
        self._rows = np.zeros((1024, width), dtype=np.float32)
        self._at: dict[str, int] = {}

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """(len(texts), width) sums in double precision."""
        cut = [words(t) for t in texts]
        at = self._at
        if len(at) > CACHE_WORDS:
            at.clear()
        new = list(set().union(*cut).difference(at))
        if new:
            first = len(at)
            at.update(zip(new, range(first, first + len(new)), strict=True))
            if len(at) > len(self._rows):
                grown = np.zeros((max(len(at), 2 * len(self._rows)), self._rows.shape[1]), dtype=np.float32)
                grown[:first] = self._rows[:first]
                self._rows = grown
            self._rows[first:len(at)] = self._value(new)
        sizes = np.array([len(c) for c in cut], dtype=np.int64)
        out = np.zeros((len(texts), self._rows.shape[1]))
        if sizes.any():
            number = np.fromiter((at[w] for c in cut for w in c), dtype=np.int64, count=int(sizes.sum()))
            some = sizes > 0
            out[some] = np.add.reduceat(self._rows[number].astype(np.float64),
                                        (np.cumsum(sizes) - sizes)[some], axis=0)
        return out
