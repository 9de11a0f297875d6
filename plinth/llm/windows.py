"""Hashes of words and of word windows, and windows' minimisers, with numpy."""

from __future__ import annotations

import numpy as np
import xxhash
from numpy.lib.stride_tricks import sliding_window_view

_U64 = np.uint64
#: Words whose hashes a task remembers; beyond it starts anew.
CACHED_WORDS = 100_000


class WordHashes(dict):
    """64-bit hashes of words. A word is a run of bytes other than a space and \\x09 to \\x0D."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=_U64, count=len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that leaves no bit where it was (splitmix64's finaliser)."""
    h = h.copy()
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> _U64(shift)
        h *= _U64(factor)
    return h ^ (h >> _U64(31))


class Rolling:
    """Hashes of all windows of a length: differences of running sums of hash * base ** place, modulo 2 ** 64."""

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 2**64)
        self.powers = self.back = np.ones(1, dtype=_U64)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 2 * len(self.powers))
            grown = []
            for b in (self.base, self.inverse):
                p = np.full(n, b, dtype=_U64)
                p[0] = 1
                grown.append(np.multiply.accumulate(p))
            self.powers, self.back = grown

    def sums(self, words: np.ndarray) -> np.ndarray:
        self._reach(len(words) + 1)
        out = np.zeros(len(words) + 1, dtype=_U64)
        np.cumsum(words * self.powers[: len(words)], out=out[1:])
        return out

    def windows(self, words: np.ndarray, length: int) -> np.ndarray:
        """One hash for each place at which a window of `length` words starts."""
        n = len(words) - length + 1
        if n <= 0:
            return np.zeros(0, dtype=_U64)
        s = self.sums(words)
        return mixed((s[length : length + n] - s[:n]) * self.back[:n])


def minimisers(grams: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` grams the place of its smallest, the leftmost of equals. Equal runs choose alike wherever they stand."""
    if len(grams) < width:
        return np.zeros(0, dtype=np.int64)
    return sliding_window_view(grams, width).argmin(axis=1) + np.arange(len(grams) - width + 1)
