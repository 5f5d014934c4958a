"""Operator 4: digests depend on the bytes alone, and the next document is the right one."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest

from tidegate.llm import digest, scan
from tidegate.llm import fingerprints as f


def entropy(window):
    counts = np.bincount(np.frombuffer(window, np.uint8))
    return -sum(c / len(window) * math.log2(c / len(window)) for c in counts if c)


def test_levels_equal_the_entropy_of_each_window():
    data = np.random.default_rng(1).choice(np.frombuffer(b"aaabbc de", np.uint8), 500)
    levels = digest.window_levels(data)
    want = [64 * (6 - entropy(data[i:i + digest.WINDOW].tobytes())) * 4 for i in range(len(levels))]
    assert np.abs(levels - np.floor(np.array(want) + 1e-4)).max() <= 1
    assert len(digest.window_levels(data[:63])) == 0


def brute_selection(text, rank):
    levels = digest.window_levels(np.frombuffer(text, np.uint8))
    keys = [(rank[v], i) if v < digest.WEAK_LEVEL else (1 << 60, i) for i, v in enumerate(levels)]
    runs = [keys[a:a + digest.RUN] for a in range(max(len(keys) - digest.RUN + 1, 1))] if keys else []
    return sorted({min(run)[1] for run in runs if min(run)[0] < 1 << 60})


def test_selection_equals_brute_force_and_ignores_neighbours():
    draw = np.random.default_rng(2)
    texts = [bytes(draw.choice(np.frombuffer(b"abcdefgh \n", np.uint8), n)) for n in (10, 64, 65, 100, 159, 160, 700, 0, 300)]
    texts.append(b"a" * 400)
    rank = draw.permutation(digest.LEVELS)
    (_, _, piece), = scan.text_chunks(pa.array([t.decode() for t in texts]))
    position, owner = digest.select(piece, rank)
    for i, text in enumerate(texts):
        assert (position[owner == i] - piece.bounds[i]).tolist() == brute_selection(text, rank)
    alone = [f.digests_of([t.decode()], rank)[0] for t in texts]
    assert alone == f.digests_of([t.decode() for t in texts], rank)
    assert alone[7] == b"" and all(alone[i] for i in range(len(texts)) if i != 7)


def test_packed_digests_are_lossless():
    draw = np.random.default_rng(6)
    filters = [np.packbits(draw.random(digest.FILTER_BITS) < p, bitorder="little").tobytes() for p in (0, 0.001, 0.01, 0.05, 0.09, 0.2, 0.5, 1)]
    edge = np.zeros(digest.FILTER_BITS, np.uint8)
    edge[[0, 255, 256, 511, 767, digest.FILTER_BITS - 1]] = 1
    filters.append(np.packbits(edge, bitorder="little").tobytes())
    for one in [b"", *filters, b"".join(filters), b"".join(filters[::-1])]:
        assert digest.unpacked(digest.packed(one)) == one
    assert len(digest.packed(filters[2])) < 40
    one, other = b"".join(filters), b"".join(filters[:4] + filters[:3])
    assert digest.unpacked(digest.packed(other, one), one) == other and digest.unpacked(digest.packed(one, other), other) == one
    assert digest.packed(other, one)[:4] == bytes([2] * 4)


@pytest.mark.parametrize("a, b, low, high", [("x", "x", 1, 1), ("", "", 1, 1), ("", "x", 0, 0), ("short", "other", 0, 0.2)])
def test_likeness_edges(a, b, low, high):
    rank = np.arange(digest.LEVELS)
    assert low <= digest.likeness(*f.digests_of([a, b], rank)) <= high


def test_likeness_of_long_texts():
    draw = np.random.default_rng(3)
    words = ["".join(draw.choice(list("abcdefghij"), draw.integers(2, 9))) for _ in range(3000)]
    one, half = " ".join(words), " ".join(words[:1500] + words[::-1][:1500])
    other = " ".join(reversed(words[:2000]))
    rank = np.arange(digest.LEVELS)
    a, b, c = f.digests_of([one, half, other], rank)
    assert len(a) > 4 * digest.FILTER_BYTES
    assert digest.likeness(a, b) == digest.likeness(b, a)
    assert 0.3 < digest.likeness(a, b) < 0.9
    assert digest.likeness(a, f.digests_of([one + " tail"], rank)[0]) > 0.9


def test_documents(odd_docs, no_docs):
    got = f.fingerprint(odd_docs).collect()
    rows = sorted(((r.doc_id, r.text) for r in odd_docs.collect()),
                  key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is None, [-ord(c) for c in r[1] or ""]))
    want = []
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        new = text[:len(text) - half] + following[:half]
        want.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=key) == sorted(want, key=key)
    texts = {(r.doc_id, r.text) for r in odd_docs.collect()}
    prints = {}
    for r in got:
        prints.setdefault(bytes(r.fingerprint), set()).update(t or "" for i, t in texts if i == r.doc_id and len(t or "") == r.n_chars)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert prints[b""] == {""}
    assert f.fingerprint(no_docs).collect() == []
    single = f.fingerprint(odd_docs.filter("doc_id = 10")).collect()
    assert len(single) == 1 and single[0].near_next == 1.0
