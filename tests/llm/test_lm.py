"""Operator 10: exact base scores, filter counts never too low, better scores than the base."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tidegate.llm import bloom, lm, scan
from tests_llm_inputs import words


def test_filter_counts():
    draw = np.random.default_rng(1)
    keys = scan.mix(np.arange(4000, dtype=np.uint64))
    counts = draw.zipf(1.6, 4000).clip(1, 10**9)
    shard = bloom.shard_of(keys, 7)
    segments = [(s, bloom.segment(keys[shard == s], counts[shard == s], 10.0, 1 << 20)) for s in range(7) if (shard == s).any()]
    found = bloom.LogBloom.of(7, segments)
    levels = found.levels(keys)
    assert (levels >= bloom.levels_of(counts)).all()
    assert (levels == bloom.levels_of(counts)).mean() > 0.95
    other = found.levels(scan.mix(np.arange(4000, 14000, dtype=np.uint64)))
    assert (other > 0).mean() < 0.05
    assert (bloom.LogBloom.of(7, []).levels(keys) == 0).all()
    dense = bloom.LogBloom.of(1, [(0, bloom.segment(keys, counts, 10.0, 64))])
    assert (dense.levels(keys) >= bloom.levels_of(counts)).all()  # a full filter reads too high, never too low


def test_levels_stand_for_their_counts():
    counts = np.arange(1, 5000)
    values = bloom.VALUES[bloom.levels_of(counts)]
    assert (values[:4] == counts[:4]).all() and (np.abs(values / counts - 1) < 0.15).all()


def expected(rows):
    out, held = [], [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    tokens = [[*words(t), "\n"] for _, t in rows]
    counts = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    for (i, _), ws, h in zip(rows, tokens, held):
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        out.append((-1 if i is None else i, h, len(ws), sum(counts[w] > 0 for w in ws), n, pytest.approx(base)))
    return out


def scored(frame):
    return [(-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lm.score_all(frame).collect()]


@pytest.mark.parametrize("group", [lm.GROUP_BYTES, 2000])
def test_base_scores(odd_docs, no_docs, monkeypatch, group):
    monkeypatch.setattr(lm, "GROUP_BYTES", group)
    key = lambda r: (r[0], r[2])
    got = sorted(scored(odd_docs), key=key)
    assert [r[:6] for r in got] == sorted(expected([(r.doc_id, r.text) for r in odd_docs.collect()]), key=key)
    assert all(math.isfinite(r[6]) and r[6] < 0 for r in got)
    assert scored(no_docs) == []


def test_held_out_alone(shipped):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1][:4]
    got = scored(shipped.createDataFrame([(i, "a b") for i in held], "doc_id bigint, text string"))
    assert all(r[3] == 0 and r[4] == 0 and r[5] == r[6] == 0 for r in got)


def test_scores_beat_the_base(shipped, sf_dir):
    got = [r for r in scored(shipped.read.parquet(f"{sf_dir}/documents.parquet")) if r[1]]
    assert sum(r[6] for r in got) > sum(r[5] for r in got)


def test_a_filter_beyond_one_broadcast_keeps_its_bits(shipped, random_docs, monkeypatch):
    frame = shipped.createDataFrame(random_docs, "doc_id bigint, text string")
    whole = sorted(scored(frame))
    monkeypatch.setattr(lm, "FILTER_BYTES", 2000)
    monkeypatch.setattr(lm, "FILTER_GROUP_BYTES", 1500)
    filters = lm.train(frame).filters
    assert len(filters) > 5 and sum(len(part.value[1]) for part in filters) > 5 * lm.FILTER_BYTES
    assert sorted(scored(frame)) == whole
