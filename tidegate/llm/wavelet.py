"""Token ids as wavelet matrices: succinct bit planes with rank and select, one file image per shard.

A shard holds the ids of whole documents in order. Its file image is

    "WMX1" | planes u8 | pad 3 | tokens u64 | documents u64 | length of the bounds block u64
    bounds block: zstd of the documents' end offsets (u64)
    one block per plane, highest bit first: zeros u64, length u64, zstd of the packed bits

All numbers are little-endian. Rank counts ones before a position from a running count per
512 bits that is rebuilt on load. Spark's Parquet writer stores the image in a binary column,
so a task that is run again replaces its own output.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"WMX1"
_HEAD = struct.Struct("<4sB3xQQQ")
_PLANE = struct.Struct("<QQ")
BLOCK_BITS = 512
_POP = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.uint16)


def encode(ids: np.ndarray, ends: np.ndarray, level: int = 1) -> bytes:
    """The file image of `ids` (unsigned) with the documents' end offsets."""
    ids = np.asarray(ids, np.uint32)
    planes = max(int(ids.max()).bit_length(), 1) if len(ids) else 1
    squeeze = zstandard.ZstdCompressor(level=level).compress
    bounds = squeeze(np.asarray(ends, "<u8").tobytes())
    parts = [_HEAD.pack(MAGIC, planes, len(ids), len(ends), len(bounds)), bounds]
    row = ids.astype(np.uint16) if planes <= 16 else ids
    for plane in range(planes - 1, -1, -1):
        ones = (row >> plane & 1).astype(bool)
        packed = squeeze(np.packbits(ones, bitorder="little").tobytes())
        parts += [_PLANE.pack(len(row) - int(np.count_nonzero(ones)), len(packed)), packed]
        row = np.concatenate([row[~ones], row[ones]])
    return b"".join(parts)


class WaveletMatrix:
    """Access, rank, select and counting over one file image."""

    def __init__(self, image: bytes):
        magic, self.planes, self.n, documents, size = _HEAD.unpack_from(image)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix file")
        expand = zstandard.ZstdDecompressor().decompress
        at = _HEAD.size
        self.ends = np.frombuffer(expand(image[at:at + size]), "<u8").astype(np.int64)
        if len(self.ends) != documents:
            raise ValueError("the bounds block does not fit the header")
        at += size
        self.zeros, self.bits = [], []
        for _ in range(self.planes):
            zeros, size = _PLANE.unpack_from(image, at)
            at += _PLANE.size
            self.zeros.append(zeros)
            self.bits.append(np.frombuffer(expand(image[at:at + size]), np.uint8))
            at += size
        self._counts: dict[int, np.ndarray] = {}

    def _bit(self, plane: int, position: int) -> int:
        return int(self.bits[plane][position >> 3]) >> (position & 7) & 1

    def _ones_before(self, plane: int, position: int) -> int:
        if plane not in self._counts:
            width = BLOCK_BITS // 8
            raw = np.zeros(-(-max(len(self.bits[plane]), 1) // width) * width, np.uint8)
            raw[:len(self.bits[plane])] = self.bits[plane]
            self._counts[plane] = np.concatenate([[0], _POP[raw].reshape(-1, width).sum(1, dtype=np.int64).cumsum()])
        block = position // BLOCK_BITS
        first = block * BLOCK_BITS // 8
        whole = int(_POP[self.bits[plane][first:position >> 3]].sum())
        rest = position & 7
        last = int(self.bits[plane][position >> 3]) & ((1 << rest) - 1) if rest else 0
        return int(self._counts[plane][block]) + whole + last.bit_count()

    def access(self, position: int) -> int:
        """The id at `position`."""
        if not 0 <= position < self.n:
            raise IndexError(position)
        value = 0
        for plane in range(self.planes):
            bit, ones = self._bit(plane, position), self._ones_before(plane, position)
            value = value << 1 | bit
            position = self.zeros[plane] + ones if bit else position - ones
        return value

    def rank(self, value: int, position: int) -> int:
        """How often `value` occurs before `position`."""
        if value < 0 or value.bit_length() > self.planes:
            return 0
        low, high = 0, min(max(position, 0), self.n)
        for plane in range(self.planes):
            a, b = self._ones_before(plane, low), self._ones_before(plane, high)
            if value >> (self.planes - 1 - plane) & 1:
                low, high = self.zeros[plane] + a, self.zeros[plane] + b
            else:
                low, high = low - a, high - b
        return high - low

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def select(self, value: int, nth: int) -> int:
        """Position of the occurrence number `nth` (from 0), by bisecting rank; -1 if there are fewer."""
        if nth < 0 or nth >= self.count(value):
            return -1
        low, high = 0, self.n - 1
        while low < high:
            middle = (low + high) // 2
            if self.rank(value, middle + 1) > nth:
                high = middle
            else:
                low = middle + 1
        return low

    def all_ids(self) -> np.ndarray:
        """Every id in order, by undoing the planes from the last to the first."""
        values = np.zeros(self.n, np.uint16 if self.planes <= 16 else np.uint32)
        for plane in range(self.planes - 1, -1, -1):
            ones = np.unpackbits(self.bits[plane], count=self.n, bitorder="little").astype(bool)
            zeros = self.zeros[plane]
            back = np.empty_like(values)
            back[~ones] = values[:zeros]
            back[ones] = values[zeros:] | values.dtype.type(1 << (self.planes - 1 - plane))
            values = back
        return values.astype(np.uint32)
