"""Words and n-gram hashes shared by the text operators.

A word is a longest run of letters or digits, compared in lower case.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\W_]+")
TAG = re.compile(r"<[^<>]*>")


def words(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def plain(text: str) -> str:
    """The text with every ``<...>`` tag replaced by a blank."""
    return TAG.sub(" ", text) if "<" in text else text


class WordHash(dict):
    """word -> 64-bit hash, kept per worker; emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 1 << 20) -> None:
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.lower().encode("utf-8", "surrogatepass"))
        return h


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive word hashes."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(out) + k])
    return out
