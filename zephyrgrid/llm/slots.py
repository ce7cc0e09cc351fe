"""A fixed table of 64-bit keys that is searched many keys at a time."""

from __future__ import annotations

import numpy as np

MIX = 0x9E3779B97F4A7C15


class SlotTable:
    """Position of each key among ``keys`` (distinct, not negative), -1 for others.

    Every slot holds one key at most; keys that find theirs taken go to a further,
    much smaller table, so a search is one look per table.
    """

    def __init__(self, keys: np.ndarray, bits: tuple[int, ...] = (20, 16, 12)):
        self.tables = []
        left = np.arange(len(keys))
        while len(left):
            size = bits[min(len(self.tables), len(bits) - 1)]
            factor = MIX + 2 * len(self.tables)
            slot = self._slots(keys[left], factor, size)
            _, first = np.unique(slot, return_index=True)
            held = np.full(1 << size, -1, np.int64)
            place = np.full(1 << size, -1, np.int32)
            held[slot[first]] = keys[left[first]]
            place[slot[first]] = left[first]
            self.tables.append((factor, size, held, place))
            left = np.delete(left, first)

    @staticmethod
    def _slots(keys: np.ndarray, factor: int, size: int) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(factor) >> np.uint64(64 - size)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(keys.shape, -1, np.int32)
        for factor, size, held, place in self.tables:
            slot = self._slots(keys, factor, size)
            found = np.where(held[slot] == keys, place[slot], found)
        return found
