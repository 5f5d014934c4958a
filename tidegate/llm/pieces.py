"""A bounded memory of the ids of text pieces, known by 64-bit hashes."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class IdStore:
    """Ids per piece; beyond `most` pieces it starts anew, so a worker's memory stays bounded."""

    def __init__(self, most: int):
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.bounds = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _add(self, keys: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> None:
        slots = np.arange(len(self.bounds) - 1, len(self.bounds) - 1 + len(lengths))
        used = int(self.bounds[-1])
        self.bounds = np.concatenate([self.bounds, used + lengths.cumsum()])
        if used + len(flat) > len(self.ids):  # room ahead, so that most additions copy nothing and no second copy stands beside
            room = np.empty((used + len(flat)) * 5 // 4, np.uint32)
            room[:used] = self.ids[:used]
            self.ids = room
        self.ids[used:used + len(flat)] = flat
        at = np.searchsorted(self.keys, keys)
        self.keys, self.slots = np.insert(self.keys, at, keys), np.insert(self.slots, at, slots)

    def lookup(self, keys: np.ndarray, learn: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in order, number of ids per piece).

        `learn` gets indices of pieces that are new and returns their ids, joined, and the counts.
        """
        if not len(keys):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) + len(unique) > self.most:
            self._clear()
        at = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == unique[inside]
        if not known.all():
            self._add(unique[~known], *learn(first[~known]))
            at = np.searchsorted(self.keys, unique)
        slots = self.slots[at][inverse]
        lengths = self.bounds[slots + 1] - self.bounds[slots]
        ends = lengths.cumsum()
        index = np.arange(int(ends[-1])) + np.repeat(self.bounds[slots] - (ends - lengths), lengths)
        return self.ids[index], lengths
