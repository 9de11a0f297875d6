"""Binary fuse filters (Graf and Lemire, 2022) over 64-bit keys, built and probed with numpy."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

_U64 = np.uint64


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """The murmur3 finaliser over key + seed."""
    h = keys + _U64(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h ^= h >> _U64(shift)
        h *= _U64(factor)
    return h ^ (h >> _U64(33))


@dataclass(frozen=True)
class BinaryFuse:
    """A static set of keys: no false negatives, and 2**-16 of the other keys pass."""

    seed: int
    segment: int
    segments: int
    cells: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray, attempts: int = 100) -> BinaryFuse:
        keys = np.unique(np.asarray(keys, dtype=_U64))
        n = max(len(keys), 2)
        segment = 1 << min(18, max(2, int(math.log(n) / math.log(3.33) + 2.25)))
        factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
        segments = max(1, math.ceil(n * factor / segment) - 2)
        for attempt in range(attempts):
            seed = (0x9E3779B97F4A7C15 * (attempt + 1)) & (2**64 - 1)
            shape = cls(seed, segment, segments, np.zeros((segments + 2) * segment, dtype=np.uint16))
            if shape._fill(keys):
                return shape
            if attempt % 10 == 9:
                segments += 1 + segments // 8
        raise RuntimeError("no seed gives a peelable hypergraph")

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Three cells for each key, in neighbouring segments, and its fingerprint."""
        h = _mix(keys, self.seed)
        first = ((h >> _U64(32)) * _U64(self.segments * self.segment)) >> _U64(32)
        mask = _U64(self.segment - 1)
        second = (first + _U64(self.segment)) ^ ((h >> _U64(18)) & mask)
        third = (first + _U64(2 * self.segment)) ^ (h & mask)
        return np.stack([first, second, third]).astype(np.int64), (h ^ (h >> _U64(32))).astype(np.uint16)

    def _fill(self, keys: np.ndarray) -> bool:
        """Peels cells that one key is left in, a whole frontier at a time, then assigns in reverse order."""
        at, prints = self._places(keys)
        number = np.arange(len(keys))
        degree = np.zeros(len(self.cells), dtype=np.int64)
        xored = np.zeros(len(self.cells), dtype=np.int64)
        for row in at:
            np.add.at(degree, row, 1)
            np.bitwise_xor.at(xored, row, number)
        frontier, peeled, left = np.flatnonzero(degree == 1), [], len(keys)
        while len(frontier):
            owners, once = np.unique(xored[frontier], return_index=True)
            cells = frontier[once]
            peeled.append((owners, cells))
            left -= len(owners)
            touched = at[:, owners]
            for row in touched:
                np.subtract.at(degree, row, 1)
                np.bitwise_xor.at(xored, row, owners)
            touched = np.unique(touched)
            frontier = touched[degree[touched] == 1]
        if left:
            return False
        for owners, cells in reversed(peeled):
            self.cells[cells] = 0
            self.cells[cells] = prints[owners] ^ np.bitwise_xor.reduce(self.cells[at[:, owners]], axis=0)
        return True

    def contains(self, keys: np.ndarray) -> np.ndarray:
        at, prints = self._places(np.asarray(keys, dtype=_U64))
        return np.bitwise_xor.reduce(self.cells[at], axis=0) == prints
