"""A minimal perfect hash over 128-bit keys, as flat numpy arrays.

Keys that meet no other key in a level's bit array are placed there, the rest go on
to the next level; a key's slot is the rank of its bit over all levels. Every slot
keeps its key, so a lookup is verified and tells absent keys from present ones.
"""

from __future__ import annotations

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xFF51AFD7ED558CCD)
# Bits of a level for each key that reaches it.
_ROOM = 2
_LEVELS = 64


def _places(high: np.ndarray, low: np.ndarray, level: int, bits: int) -> np.ndarray:
    mixed = high + (low + np.uint64(level)) * _MIX
    mixed ^= mixed >> np.uint64(32)
    mixed = (mixed + np.uint64(level)) * _MIX2
    mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX
    return (mixed >> np.uint64(11)) % np.uint64(bits)


class PerfectHash:
    """Slots 0 to n - 1 for n distinct keys given as two arrays of unsigned 64-bit numbers."""

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.size = len(high)
        self._levels: list[tuple[int, np.ndarray]] = []
        rest, placed = np.arange(self.size), 0
        for level in range(_LEVELS):
            if not len(rest):
                break
            bits = _ROOM * len(rest) + 1
            place = _places(high[rest], low[rest], level, bits)
            alone = np.bincount(place, minlength=bits) == 1
            rank = np.where(alone, placed + np.cumsum(alone) - 1, -1)
            self._levels.append((bits, rank))
            placed += int(alone.sum())
            rest = rest[~alone[place]]
        if len(rest):
            raise ValueError("a key stands twice")
        self._high, self._low = np.empty_like(high), np.empty_like(low)
        slots = self._raw(high, low)
        self._high[slots], self._low[slots] = high, low
        if self.size and not (np.bincount(slots, minlength=self.size) == 1).all():
            raise ValueError("two keys share a slot")

    def _raw(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        slots = np.full(len(high), -1, dtype=np.int64)
        rest = np.arange(len(high))
        for level, (bits, rank) in enumerate(self._levels):
            if not len(rest):
                break
            found = rank[_places(high[rest], low[rest], level, bits)]
            slots[rest] = found
            rest = rest[found < 0]
        return slots

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for keys that are not in the table."""
        slots = self._raw(high, low)
        if not self.size:
            return slots
        same = (self._high[slots] == high) & (self._low[slots] == low)
        return np.where(same & (slots >= 0), slots, -1)
