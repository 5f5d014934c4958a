"""Operator 6: links and components against brute force, recall, and vectors that cannot link."""

import math

import numpy as np
import pytest

from tidegate.llm import near_vectors, quantiser
from tidegate.llm.components import connected_components


def brute(rows, threshold=near_vectors.THRESHOLD):
    usable = [i for i, (v, e, l) in enumerate(rows) if v is not None and l is not None and e is not None and len(e)
              and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    links, parent = [0] * len(rows), {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a in usable:
        for b in usable:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[i][1], np.float64) for i in (a, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    p, q = sorted((find(rows[a][0]), find(rows[b][0])))
                    parent[q] = p
    return sorted(((v if v is not None else -1), n, (find(v) if v is not None else -1)) for (v, _, _), n in zip(rows, links))


def clustered(n, width, seed, spread=0.16):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(n // 6, width))
    x = centres[draw.integers(0, len(centres), n)]
    return x / np.linalg.norm(x, axis=1)[:, None] + draw.normal(size=(n, width)) * spread / np.sqrt(width)


@pytest.mark.parametrize("block, cell", [(2048, 1024), (16, 30)])
def test_equals_brute_force(shipped, monkeypatch, block, cell):
    monkeypatch.setattr(near_vectors, "VECTORS_PER_CELL", cell)
    x = clustered(240, 16, 1)
    rows = [(i, [float(v) for v in x[i]], i % 3) for i in range(240)]
    rows += [(300 + i, rows[5][1], rows[5][2]) for i in range(20)] + [(400, [v * 3 for v in rows[5][1]], rows[5][2])]
    got = near_vectors.near_vectors(shipped.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"), block=block).collect()
    have = sorted((r.vec_id, r.n_links, r.component_id) for r in got)
    want = brute(rows)
    # Many small cells are the hard case for the probes.
    assert sum(n for _, n, _ in have) >= (1 if cell == 1024 else 0.97) * sum(n for _, n, _ in want)
    assert all(a[1] <= b[1] for a, b in zip(have, want))
    if cell == 1024:
        assert have == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_probes_are_the_same_however_gaps_of_cells_are_found(monkeypatch):
    x = clustered(300, 16, 4)
    x /= np.linalg.norm(x, axis=1)[:, None]
    found = quantiser.Quantiser.fit(x, 40, 0.93)
    cell, _, _ = found.encode(x)
    gaps = np.linalg.norm(found.cells[:, None] - found.cells[None], axis=2)
    assert np.abs(found._gaps_of(cell) - gaps[cell]).max() < 1e-6
    kept = [p.tolist() for p in found.probes(x, cell)]
    monkeypatch.setattr(quantiser, "KEPT_GAPS", 0)
    assert [p.tolist() for p in found.probes(x, cell)] == kept
    assert all(c in p for c, p in zip(cell, kept))


def test_vectors_that_cannot_link(shipped):
    e, near = [1.0, 2.0], [1.0, 2.01]
    rows = [(0, e, 1), (1, near, 1), (2, e, 2), (3, None, 1), (4, [0.0, 0.0], 1), (5, [1.0, None], 1), (6, [float("nan"), 2.0], 1),
            (7, [float("inf"), 2.0], 1), (8, e, None), (9, [], 1), (10, [1.0, 2.0, 0.0], 1), (None, e, 1), (11, e, 1), (11, e, 1),
            (12, [-1.0, -2.0], 1), (13, [1e200, 2e200], 1), (14, [1e-200, 2e-200], 1), (15, [-0.0, 1.0], 3), (16, [0.0, 1.0], 3)]
    frame = shipped.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").selectExpr("*", "1 AS id", "2 AS cell")
    got = sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, -1 if r.component_id is None else r.component_id)
                 for r in near_vectors.near_vectors(frame).collect())
    want = [r for r in brute([r for r in rows if r[0] not in (13, 14)])]
    have = {r[0]: r for r in got}
    # The brute force overflows on 13 and 14; they point the same way as 0.
    assert have[13][1] == have[14][1] == 5 and have[13][2] == have[14][2] == 0
    linked = {0, 1, 11}
    assert [r for r in got if r[0] not in linked | {13, 14}] == [r for r in want if r[0] not in linked]
    assert [(v, n - 2, c) for v, n, c in got if v in linked] == [r for r in want if r[0] in linked]
    assert near_vectors.near_vectors(frame.limit(0)).collect() == []


def test_bound_of_estimates_loses_no_link():
    x = clustered(400, 24, 3)
    x /= np.linalg.norm(x, axis=1)[:, None]
    q = quantiser.Quantiser.fit(x[:200], 5, 0.93)
    cell, code, least = q.encode(x)
    for c in range(5):
        own = np.flatnonzero(cell == c)
        close = x @ x[own].T >= 0.93
        estimates = q.estimates(x, c, code[own])
        assert (estimates >= least[own])[close].all()
        back = q.cells[c] + q._join(code[own], 24)
        assert np.allclose(estimates, x @ back.T)


def test_recall_of_the_probes():
    x = clustered(3000, 64, 4, spread=0.25)
    x /= np.linalg.norm(x, axis=1)[:, None]
    q = quantiser.Quantiser.fit(x[:1500], 40, 0.93)
    cell, _, _ = q.encode(x)
    probes = [set(p.tolist()) for p in q.probes(x, cell)]
    a, b = np.nonzero(np.triu(x @ x.T >= 0.93, 1))
    found = [cell[j] in probes[i] or cell[i] in probes[j] for i, j in zip(a, b)]
    assert len(found) > 1000 and np.mean(found) >= 0.98


def test_components(shipped):
    draw = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 300, (180, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [
        (2000, 2000 + i) for i in range(1, 50)] + [(7, 7), (8, 9), (9, 8)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        p, q = sorted((find(a), find(b)))
        parent[q] = p
    got = connected_components(shipped.createDataFrame(edges, "a bigint, b bigint"), "test").collect()
    assert len({r.node for r in got}) == len(got)
    assert {r.node: r.component for r in got} == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert connected_components(shipped.createDataFrame([], "a bigint, b bigint"), "test").collect() == []
