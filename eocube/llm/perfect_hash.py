"""A minimal perfect hash of 64-bit keys, vectorised: n distinct keys get the slots 0 to n - 1.

Keys that fall alone on a bit of a first table twice as wide as there are keys
stay there; the others go to the next table, and so on. A key's slot is the rank
of its bit. A key that isn't one of the n gets some slot or none, so whoever asks
must compare the key that is stored at the slot.
"""

from __future__ import annotations

import numpy as np

from .text import mix

_U = np.uint64
LEVELS = 64


class Slots:
    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.n = len(keys)
        left, base = keys, 0
        while len(left):
            if len(self.levels) == LEVELS:
                raise ValueError("the keys aren't distinct")
            size = -(-2 * len(left) // 64) * 64
            at = self._at(left, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            bits = np.packbits(alone, bitorder="little").view(_U)
            rank = base + np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)[:-1]])
            self.levels.append((bits, rank, size))
            base += int(alone.sum())
            left = left[~alone[at]]

    @staticmethod
    def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        h = mix(keys + _U((level + 1) * 0x9E3779B97F4A7C15 % 2**64))
        return (((h >> _U(32)) * _U(size)) >> _U(32)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """A slot for each key, -1 for some of those that have none."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, (bits, rank, size) in enumerate(self.levels):
            at = self._at(keys[todo], level, size)
            word, bit = at >> 6, (at & 63).astype(_U)
            there = (bits[word] >> bit) & _U(1) == 1
            w, b = word[there], bit[there]
            out[todo[there]] = rank[w] + np.bitwise_count(bits[w] & ((_U(1) << b) - _U(1)))
            todo = todo[~there]
            if not len(todo):
                break
        return out
