"""Shingle sets of texts as arrays, and the parts of the join that work on arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tidegate.llm import scan

WIDTH = 5
BUCKETS = 256
MOST_TEXTS = 1 << 12  # texts of one piece, so that text number and shingle fit one sort key
_U = np.uint64
_OTHER = _U(0x8EBC6AF09C88C6E3)


@dataclass
class Sets:
    """Distinct shingles (52-bit keys) of some texts, ascending within each text."""

    keys: np.ndarray
    bounds: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.sizes)

    def class_keys(self) -> np.ndarray:
        """A 64-bit key of each whole set, independent of order."""
        one = np.concatenate([[_U(0)], np.cumsum(scan.mix(self.keys + _U(1)), dtype=np.uint64)])
        two = np.concatenate([[_U(0)], np.cumsum(scan.mix(self.keys ^ _OTHER), dtype=np.uint64)])
        a, b = self.bounds[:-1], self.bounds[1:]
        return scan.mix((one[b] - one[a]) * _OTHER + (two[b] - two[a]) + self.sizes.astype(_U))

    def histograms(self) -> np.ndarray:
        """How many shingles of each text fall into each of BUCKETS classes of keys."""
        rows = len(self.bounds) - 1
        at = self.owners() * BUCKETS + (self.keys & _U(BUCKETS - 1)).astype(np.int64)
        return np.bincount(at, minlength=rows * BUCKETS).reshape(rows, BUCKETS)


def sets_of(texts: scan.Texts, width: int = WIDTH) -> Sets:
    """Runs of `width` lower-cased words of each text; a shorter text has its whole word sequence as one."""
    rows = len(texts)
    starts, stops, owner = texts.words()
    words = scan.span_hashes(texts.lowered(), starts, stops)
    counts = np.bincount(owner, minlength=rows)
    runs = scan.combine(words, width)
    inside = owner[:max(len(owner) - width + 1, 0)] == owner[width - 1:]
    keys, of = runs[inside], owner[:len(runs)][inside]
    first = np.concatenate([[0], counts.cumsum()])
    for size in range(1, width):
        short = np.flatnonzero(counts == size)
        if len(short):
            whole = scan.combine(words, size)[first[short]]
            keys, of = np.concatenate([keys, whole]), np.concatenate([of, short])
    ordered = np.sort((of.astype(_U) << _U(52)) | (keys >> _U(12)))
    if len(ordered):
        ordered = ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])]
    edges = np.searchsorted(ordered, np.arange(rows + 1).astype(_U) << _U(52)) if rows < MOST_TEXTS else np.append(
        np.searchsorted(ordered, np.arange(rows).astype(_U) << _U(52)), len(ordered))
    return Sets(ordered & _U((1 << 52) - 1), edges.astype(np.int64))


def pieces(column: pa.Array) -> Iterator[tuple[int, int, scan.Texts]]:
    """Pieces of a text column of at most MOST_TEXTS texts."""
    for a, b, texts in scan.text_chunks(column):
        for c in range(0, len(texts), MOST_TEXTS):
            d = min(c + MOST_TEXTS, len(texts))
            bounds = texts.bounds[c:d + 1]
            yield a + c, a + d, scan.Texts(texts.data[bounds[0]:bounds[-1]], bounds - bounds[0])


def least_shared(sizes: np.ndarray, percent: int) -> np.ndarray:
    """The fewest shingles a set shares with any set linked to it."""
    return -(-sizes * percent // 100)


def windows(sets: Sets, percent: int, hot_keys: np.ndarray, hot_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, text, place) of the regions each set is copied to.

    Shingles are ordered by (count among the frequent ones, else 0; key). The window is the first
    size - least_shared + 1 of a set: two linked sets share a shingle of both windows.
    """
    sizes = sets.sizes
    length = np.where(sizes > 0, sizes - least_shared(sizes, percent) + 1, 0)
    owner = sets.owners()
    counts = np.zeros(len(sets.keys), np.int64)
    if len(hot_keys):
        at = np.minimum(np.searchsorted(hot_keys, sets.keys), len(hot_keys) - 1)
        counts = np.where(hot_keys[at] == sets.keys, hot_counts[at], 0)
    order = np.arange(len(counts))
    if counts.any():
        # Only texts with frequent shingles need another order than that of the keys.
        mixed = np.unique(owner[counts > 0])
        some = np.isin(owner, mixed)
        rows = np.flatnonzero(some)
        order[rows] = rows[np.lexsort((sets.keys[rows], counts[rows], owner[rows]))]
    place = np.arange(len(order)) - sets.bounds[:-1][owner]
    held = place < length[owner]
    return sets.keys[order][held], owner[held], place[held]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two ascending sets reach the similarity."""
    if not len(a) or not len(b):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)
