"""Vectorised scans over the UTF-8 bytes of Arrow string columns.

Texts of one Arrow batch lie in one buffer, so splitting into words, hashing words and
counting byte classes are numpy passes over that buffer instead of loops over texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
# Workers live long: give batches back to the system instead of keeping them in a pool.
pa.set_memory_pool(pa.system_memory_pool())
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = 0x9E3779B97F4A7C15 | 5
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_random = np.random.default_rng(20240607)
_BYTE_KEYS = _random.integers(0, 2**64, 256, dtype=np.uint64)
_powers = {"n": -1}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on each other."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def _geometric(ratio: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.concatenate(
            [np.ones(1, np.uint64), np.full(max(n - 1, 0), ratio, np.uint64)]))[:n]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        size = max(n, CHUNK_BYTES)
        _powers.update(n=size, up=_geometric(_BASE, size), down=_geometric(pow(_BASE, -1, 1 << 64), size))
    return _powers["up"], _powers["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span, in a few passes over `data`.

    Polynomial prefix sums over random byte keys modulo 2**64, shifted back to the span's
    start, with the length mixed in. Two different spans collide with chance about 2**-64.
    """
    up, down = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_KEYS[data] * up[:len(data)], out=sums[1:])
    at = np.minimum(starts, max(len(data) - 1, 0))
    raw = (sums[ends] - sums[starts]) * down[at]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def combine(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every run of `width` neighbouring values."""
    n = len(h) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(width):
        out = out * np.uint64(_BASE) + h[k:k + n] if n > 0 else out
    return mix(out + np.uint64(width))


def binary_views(column: pa.Array) -> list[np.ndarray]:
    """The cells of a binary column as byte arrays, without copies."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else [0]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


class Texts:
    """A slice of a string column: its bytes and where each text begins and ends."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def words(self, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text index) of every maximal run without ASCII white space."""
        space = _SEPARATOR[self.data]
        n = len(space)
        inside = ~space
        first = inside.copy()
        first[1:] &= space[:-1]
        last = inside.copy()
        last[:-1] &= space[1:]
        begins = self.bounds[:-1][np.diff(self.bounds) > 0]
        first[begins] = inside[begins]
        ends = self.bounds[1:][np.diff(self.bounds) > 0] - 1
        last[ends] = inside[ends]
        starts = np.flatnonzero(first)
        stops = np.flatnonzero(last) + 1
        return starts, stops, np.searchsorted(self.bounds, starts, "right") - 1 if n else starts

    def lowered(self) -> np.ndarray:
        return LOWER[self.data]


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, int64 bounds) of a string column; a null counts as an empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, bounds


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, end row, texts) in pieces of about `most` bytes; a longer text is a piece of its own."""
    raw, bounds = string_buffers(column)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        stop = max(int(np.searchsorted(bounds, bounds[row] + most, "right")) - 1, row + 1)
        stop = min(stop, rows)
        own = bounds[row:stop + 1] - bounds[row]
        yield row, stop, Texts(raw[bounds[row]:bounds[stop]], own)
        row = stop
