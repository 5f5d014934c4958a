"""Improbable-feature digests of byte texts, and how alike two digests are.

Every window of WINDOW bytes has an entropy; windows whose entropy level is rare in the corpus
rank first. In each run of RUN neighbouring windows the best ranked one is selected (the first
of equals). Selected windows are hashed into a chain of Bloom filters of FILTER_BYTES, at most
PER_FILTER features each. Entropy is kept in exact integers, so equal bytes always get equal
digests, wherever they stand in a batch.
"""

from __future__ import annotations

import numpy as np

from tidegate.llm import scan

WINDOW, RUN = 64, 96
FILTER_BYTES, PER_FILTER, HASHES = 256, 160, 5
FILTER_BITS = FILTER_BYTES * 8
_SCALE = 20
LEVELS = (384 << 2) + 2
WEAK_LEVEL = 288 << 2  # windows under 1.5 bits a byte are passed over
_n = np.arange(WINDOW + 1, dtype=np.float64)
_terms = np.round(_n * np.log2(np.maximum(_n, 1)) * (1 << _SCALE)).astype(np.int64)
_STEP = np.diff(_terms)  # what one more byte of a value adds
_POP = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.int64)


def window_levels(data: np.ndarray) -> np.ndarray:
    """The entropy level of the window at each position; a low entropy is a high level."""
    count = len(data) - WINDOW + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    back, ahead = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for lag in range(1, WINDOW):
        same = (data[lag:] == data[:-lag]).view(np.uint8)
        back[lag:] += same
        ahead[:-lag] += same
    total = np.empty(count, np.int64)
    total[0] = _terms[np.bincount(data[:WINDOW], minlength=256)].sum()
    total[1:] = _STEP[back[WINDOW:]] - _STEP[ahead[:count - 1]]
    return np.cumsum(total) >> (_SCALE - 2)


def level_counts(texts: scan.Texts) -> np.ndarray:
    """How many windows inside the texts have each level."""
    levels = window_levels(texts.data)
    return np.bincount(levels[_inside(texts, len(levels))], minlength=LEVELS)


def _inside(texts: scan.Texts, count: int) -> np.ndarray:
    """Positions whose window does not leave its text."""
    step = np.zeros(count + 1, np.int64)
    sizes = np.diff(texts.bounds) - WINDOW + 1
    long = sizes > 0
    np.add.at(step, texts.bounds[:-1][long], 1)
    np.add.at(step, texts.bounds[:-1][long] + sizes[long], -1)
    return np.cumsum(step[:-1]) > 0


def select(texts: scan.Texts, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, text index) of the selected windows, in order."""
    levels = window_levels(texts.data)
    count = len(levels)
    if not count:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = _inside(texts, count)
    key = rank[levels] << 40 | np.arange(count)
    key[~inside | (levels >= WEAK_LEVEL)] = np.iinfo(np.int64).max
    padded = np.full(-(-count // RUN) * RUN, np.iinfo(np.int64).max)
    padded[:count] = key
    blocks = padded.reshape(-1, RUN)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    back = np.minimum.accumulate(blocks, axis=1).ravel()
    sizes = np.diff(texts.bounds) - WINDOW + 1
    starts = texts.bounds[:-1]
    picked = []
    if count >= RUN:
        best = np.minimum(ahead[:count - RUN + 1], back[RUN - 1:count])
        step = np.zeros(count - RUN + 2, np.int64)  # runs that stay inside one text
        full = sizes >= RUN
        np.add.at(step, starts[full], 1)
        np.add.at(step, starts[full] + sizes[full] - RUN + 1, -1)
        picked.append(best[np.cumsum(step[:-1]) > 0])
    short = np.flatnonzero((sizes > 0) & (sizes < RUN))
    if len(short):
        edges = np.stack([starts[short], starts[short] + sizes[short]], 1).ravel()
        picked.append(np.minimum.reduceat(np.append(key, np.iinfo(np.int64).max), edges)[::2])
    chosen = np.concatenate(picked) if picked else np.zeros(0, np.int64)
    chosen = np.unique(chosen[chosen < np.iinfo(np.int64).max] & ((1 << 40) - 1))
    return chosen, np.searchsorted(texts.bounds, chosen, "right") - 1


def digests(texts: scan.Texts, rank: np.ndarray) -> list[bytes]:
    """The chained filters of each text; an empty text has none."""
    position, owner = select(texts, rank)
    hashes = scan.span_hashes(texts.data, position, position + WINDOW)
    # A text without a usable window is one feature as a whole.
    sizes = np.diff(texts.bounds)
    bare = np.flatnonzero((np.bincount(owner, minlength=len(texts)) == 0) & (sizes > 0))
    if len(bare):
        whole = scan.span_hashes(texts.data, texts.bounds[bare], texts.bounds[bare + 1])
        owner, hashes = np.concatenate([owner, bare]), np.concatenate([hashes, whole])
        order = np.argsort(owner, kind="stable")
        owner, hashes = owner[order], hashes[order]
    counts = np.bincount(owner, minlength=len(texts))
    filters = -(-counts // PER_FILTER)
    first_filter = np.concatenate([[0], filters.cumsum()])
    first_feature = np.concatenate([[0], counts.cumsum()])
    slot = first_filter[owner] + (np.arange(len(owner)) - first_feature[owner]) // PER_FILTER
    bits = np.zeros(int(first_filter[-1]) * FILTER_BITS, np.uint8)
    for k in range(HASHES):
        bits[slot * FILTER_BITS + (hashes >> np.uint64(12 * k) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = 1
    raw = np.packbits(bits, bitorder="little").tobytes()
    return [raw[a * FILTER_BYTES:b * FILTER_BYTES] for a, b in zip(first_filter[:-1], first_filter[1:])]


def packed(digest: bytes, base: bytes = b"") -> bytes:
    """A shorter form of a digest: filters with few bits as gaps between their bits, which are mostly below 255.

    Each filter starts with its kind: 2 if it is the filter of `base` at its place, 0 for all its bytes, otherwise 1, the number of codes (two bytes) and the codes; 255 passes over
    255 bits without one.
    """
    out = []
    for a in range(0, len(digest), FILTER_BYTES):
        raw = digest[a:a + FILTER_BYTES]
        if raw == base[a:a + FILTER_BYTES]:
            out.append(b"\2")
            continue
        if int.from_bytes(raw, "little").bit_count() < FILTER_BYTES * 3 // 4:
            places = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little"))
            gaps = np.diff(places, prepend=-1) - 1
            codes = b"".join(b"\xff" * (g // 255) + bytes((g % 255,)) for g in gaps.tolist())
            if len(codes) + 2 < FILTER_BYTES:
                out.append(b"\1" + len(codes).to_bytes(2, "little") + codes)
                continue
        out.append(b"\0" + raw)
    return b"".join(out)


def unpacked(raw: bytes, base: bytes = b"") -> bytes:
    out, at = [], 0
    while at < len(raw):
        if raw[at] == 2:
            out.append(base[len(out) * FILTER_BYTES:(len(out) + 1) * FILTER_BYTES])
            at += 1
            continue
        if raw[at] == 0:
            out.append(raw[at + 1:at + 1 + FILTER_BYTES])
            at += 1 + FILTER_BYTES
            continue
        size = int.from_bytes(raw[at + 1:at + 3], "little")
        bits, place = 0, -1
        for code in raw[at + 3:at + 3 + size]:
            place += code
            if code < 255:
                place += 1
                bits |= 1 << place
        out.append(bits.to_bytes(FILTER_BYTES, "little"))
        at += 3 + size
    return b"".join(out)


def _matrix(digest: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(digest, np.uint8).reshape(-1, FILTER_BYTES), axis=1, bitorder="little")


def likeness(a: bytes, b: bytes) -> float:
    """0 to 1: bit overlap above what chance gives, each filter of the shorter digest against its best match."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    if len(a) == len(b) == FILTER_BYTES:
        x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
        na, nb = x.bit_count(), y.bit_count()
        chance = na * nb / FILTER_BITS
        return min(max(((x & y).bit_count() - chance) / max(min(na, nb) - chance, 1e-9), 0.0), 1.0)
    if (len(a), a) > (len(b), b):
        a, b = b, a
    own, total, weight = _matrix(a).astype(np.float32), 0.0, 0.0
    other = _matrix(b).astype(np.float32)
    ones = other.sum(1)
    for row in own:
        n = float(row.sum())
        chance = n * ones / FILTER_BITS
        score = (other @ row - chance) / np.maximum(np.minimum(n, ones) - chance, 1e-9)
        total += n * float(np.clip(score, 0, 1).max())
        weight += n
    return total / weight if weight else 0.0
