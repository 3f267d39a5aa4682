"""Word hashing shared by the operators that compare documents word by word (runs inside tasks)."""

from __future__ import annotations

import sys

import numpy as np
import xxhash
from pyspark import cloudpickle

from routeflow.llm.common import WORD_RE

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not import this package

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_C = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser: a bijection that scatters 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """word -> 64-bit hash, kept for at most ``limit`` words."""

    limit = 500_000

    def __init__(self, seed: int = 0, limit: int | None = None) -> None:
        super().__init__()
        self.seed = seed
        self.limit = limit or self.limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"), self.seed)
        return h

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def split_words(text: str) -> list[str]:
    return WORD_RE.findall(text)


def window_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """One 64-bit hash per window of ``size`` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = mix64(words[:n] + np.array([seed], np.uint64) * _C)
    for k in range(1, size):
        out = mix64(out * _A + words[k : k + n])
    return out
