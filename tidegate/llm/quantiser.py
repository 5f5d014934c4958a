"""Product quantisation in numpy: coarse cells, residual codes, and which cells to probe.

Vectors are unit length. Two vectors with a cosine of at least t lie within r = sqrt(2 - 2t).

A code replaces y by its reconstruction q. With b = 1 - y.q and e = |y - q|, every x with x.y >= t has
x.q >= t * (1 - b) - sqrt(1 - t^2) * sqrt(e^2 - b^2): the part of the error along y is known, the part
across it counts with the sine at most. So a vector passed over by that bound is never a link.

Probes are all cells c whose squared distance exceeds the nearest cell's, n, by no more than
MARGIN * 2 r |c - n| / sqrt(d): a neighbour moves the comparison of two cells by the component of its offset
along c - n, which for an offset of length r spreads with r / sqrt(d). This is the one place
where links can be missed; the tests measure the recall.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np

MARGIN = 3.5
ROUNDS = 10
KEPT_GAPS = 512  # cells up to which a worker keeps the distances of all pairs of cells (2 MB)


def _kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = max(min(k, len(x)), 1)
    centres = x[np.sort(rng.choice(len(x), k, replace=False))].copy()
    for _ in range(ROUNDS):
        at = nearest(x, centres)
        counts = np.bincount(at, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    half = (centres**2).sum(1) / 2
    for a in range(0, len(x), 4096):
        out[a:a + 4096] = (half - x[a:a + 4096] @ centres.T).argmin(1)
    return out


@dataclass
class Quantiser:
    cells: np.ndarray  # (cells, d)
    books: np.ndarray  # (subspaces, codewords, d / subspaces), padded with zeros
    threshold: float

    @classmethod
    def fit(cls, sample: np.ndarray, cells: int, threshold: float, subspaces: int = 8, codewords: int = 256) -> Quantiser:
        """Fit on a bounded sample of unit vectors."""
        centres = _kmeans(sample, cells, 11)
        residual = cls._split(sample - centres[nearest(sample, centres)], subspaces)
        books = np.zeros((subspaces, codewords, residual.shape[2]))
        for s in range(subspaces):
            found = _kmeans(residual[:, s], codewords, 100 + s)
            books[s] = found[np.arange(codewords) % len(found)]
        return cls(centres, books, threshold)

    @staticmethod
    def _split(x: np.ndarray, subspaces: int) -> np.ndarray:
        width = -(-x.shape[1] // subspaces)
        padded = np.zeros((len(x), subspaces * width))
        padded[:, :x.shape[1]] = x
        return padded.reshape(len(x), subspaces, width)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell, residual code, least estimate of a link) of each vector."""
        cell = nearest(x, self.cells)
        parts = self._split(x - self.cells[cell], len(self.books))
        code = np.stack([nearest(parts[:, s], book) for s, book in enumerate(self.books)], 1).astype(np.uint8)
        back = self.cells[cell] + self._join(code, x.shape[1])
        along = 1 - (x * back).sum(1)
        across = np.sqrt(np.maximum(((x - back) ** 2).sum(1) - along**2, 0))
        t = self.threshold
        return cell, code, t * (1 - along) - np.sqrt(1 - t * t) * across - 1e-9

    def _join(self, code: np.ndarray, d: int) -> np.ndarray:
        return np.concatenate([book[code[:, s]] for s, book in enumerate(self.books)], 1)[:, :d]

    @cached_property
    def _square(self) -> np.ndarray:
        return (self.cells**2).sum(1)

    @cached_property
    def _gaps(self) -> np.ndarray:
        return self._gaps_of(np.arange(len(self.cells)))

    def _gaps_of(self, cell: np.ndarray) -> np.ndarray:
        """Distances of the cells `cell` to all cells."""
        return np.sqrt(np.maximum(self._square[cell][:, None] + self._square - 2 * self.cells[cell] @ self.cells.T, 0))

    def probes(self, x: np.ndarray, cell: np.ndarray) -> list[np.ndarray]:
        """All cells that may hold a neighbour of each vector, its own included."""
        reach = MARGIN * 2 * np.sqrt(2 - 2 * self.threshold) / np.sqrt(x.shape[1])
        out = []
        for a in range(0, len(x), 1024):
            part, own = x[a:a + 1024], cell[a:a + 1024]
            far = self._square - 2 * part @ self.cells.T
            extra = far - far[np.arange(len(part)), own][:, None]
            between = self._gaps[own] if len(self.cells) <= KEPT_GAPS else self._gaps_of(own)
            near = extra <= reach * between
            near[np.arange(len(part)), own] = True
            out += [np.flatnonzero(row) for row in near]
        return out

    def estimates(self, queries: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric inner products of whole queries with coded vectors of one cell, by table lookup."""
        parts = self._split(queries, len(self.books))
        out = np.repeat((queries @ self.cells[cell])[:, None], len(codes), 1)
        for s, book in enumerate(self.books):
            out += (parts[:, s] @ book.T)[:, codes[:, s]]
        return out
