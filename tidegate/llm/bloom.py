"""A log-frequency Bloom filter: n-gram counts as repeated membership.

Counts are quantised to the levels 1, 2, 3, ... whose lower ends grow by GROWTH. An n-gram of
level q is inserted q times, as (n-gram, 1) to (n-gram, q); a lookup probes level after level until
one is missing. A count is never read too low, and too high only by false positives, each with
the chance of one filter lookup.

The filter is built in segments, one per shard of the key space, so that tasks fill
them independently; a key always lives in the segment of its shard.
"""

from __future__ import annotations

import math

import numpy as np

from tidegate.llm import scan

GROWTH, HASHES = 1.25, 4
_U = np.uint64
_LEVEL_KEY, _PROBE_KEY = _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F)


def _thresholds() -> np.ndarray:
    out = [1]
    while out[-1] < 2**62:
        out.append(max(out[-1] + 1, math.ceil(out[-1] * GROWTH)))
    return np.array(out, np.int64)


THRESHOLDS = _thresholds()
#: The count that a level stands for: the middle of its range; level 0 is no occurrence.
VALUES = np.concatenate([[0.0], (THRESHOLDS[:-1] + THRESHOLDS[1:] - 1) / 2, [float(THRESHOLDS[-1])]])


def levels_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(THRESHOLDS, counts, "right")


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (scan.mix(keys ^ _PROBE_KEY) % _U(shards)).astype(np.int64)


def _positions(keys: np.ndarray, level: np.ndarray | int, bits: np.ndarray | int) -> list[np.ndarray]:
    first = scan.mix(keys + np.asarray(level, np.uint64) * _LEVEL_KEY)
    second = scan.mix(first ^ _PROBE_KEY) | _U(1)
    return [((first + _U(k) * second) % np.asarray(bits, np.uint64)).astype(np.int64) for k in range(HASHES)]


def segment(keys: np.ndarray, counts: np.ndarray, bits_per_insertion: float, most_bytes: int | None = None) -> bytes:
    """The segment of one shard, if asked at most `most_bytes` long."""
    levels = levels_of(counts)
    size = max(math.ceil(int(levels.sum()) * bits_per_insertion / 8), 1)
    if most_bytes is not None:
        size = max(min(size, most_bytes), 1)
    flags = np.zeros(size * 8, np.uint8)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for position in _positions(keys[levels >= level], level, size * 8):
            flags[position] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def joined(shards: int, segments: list[tuple[int, bytes]]) -> tuple[np.ndarray, bytes]:
    """(bytes of each shard's segment, all segments in the order of shards)."""
    sizes = np.zeros(shards, np.int64)
    for shard, raw in segments:
        sizes[shard] = len(raw)
    return sizes, b"".join(raw for _, raw in sorted(segments))


class LogBloom:
    """Lookup over all segments."""

    def __init__(self, sizes: np.ndarray, raw: bytes):
        self.shards = len(sizes)
        self.starts = np.concatenate([[0], sizes.cumsum()])
        self.bits = (sizes * 8).astype(np.uint64)
        self.raw = np.frombuffer(raw, np.uint8)

    @classmethod
    def of(cls, shards: int, segments: list[tuple[int, bytes]]) -> LogBloom:
        return cls(*joined(shards, segments))

    def levels(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        shard = shard_of(keys, self.shards)
        alive = np.flatnonzero(self.bits[shard] > 0)
        level = 1
        while len(alive) and level <= len(THRESHOLDS):
            own = shard[alive]
            held = np.ones(len(alive), bool)
            for position in _positions(keys[alive], level, self.bits[own]):
                held &= (self.raw[self.starts[own] + (position >> 3)] >> (position & 7).astype(np.uint8) & 1).astype(bool)
            alive = alive[held]
            out[alive] = level
            level += 1
        return out

    def counts(self, keys: np.ndarray) -> np.ndarray:
        return VALUES[self.levels(keys)]
