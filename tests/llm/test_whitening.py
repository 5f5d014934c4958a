"""Whitened vectors against the eigenvectors of the exact covariance."""

from fractions import Fraction

import numpy as np
import pytest

from tidegate.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>"


def result(df, components=16):
    return {(r.vec_id, r.component): r for r in whitening.whiten(df, components).collect()}


def integers(rows):
    return np.floor(np.float64(np.float32(rows)) * 64).astype(np.int64) + 1_000_000


def check(rows, got, components):
    x = integers([r for _, r in rows])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = (n * fit - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == len(rows) * components
    for k in range(components):
        own = np.array([got[i, k + 1].whitened for i, _ in rows])
        want = (n * x - sums) / n @ vectors[:, k] / np.sqrt(values[k])
        assert np.allclose(own, want, rtol=0, atol=1e-8) or np.allclose(own, -want, rtol=0, atol=1e-8)
        assert abs(got[rows[0][0], k + 1].explained / (values[k] / values.sum()) - 1) < 1e-9
    for (i, _), v in zip(rows, x):
        assert got[i, 1].deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, sums)) and got[i, 1].n == n
    assert max(r.identity_error for r in got.values()) < 1e-9


@pytest.mark.parametrize("width,count", [(24, 300), (40, 1500), (7, 60)])
def test_equals_eigenvectors(shipped, width, count):
    draw = np.random.default_rng(width)
    rows = draw.normal(size=(count, width)) * np.geomspace(3, 0.05, width) @ np.linalg.qr(draw.normal(size=(width, width)))[0]
    rows = [(i, [float(c) for c in r]) for i, r in enumerate(rows)]
    rows += [(count + i, rows[0][1]) for i in range(200)]  # copies count once
    df = shipped.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS x", "'a' AS width", "2 AS n").repartition(5)
    check(rows, result(df), min(width, 16))


def test_scales_far_apart(shipped):
    draw = np.random.default_rng(3)
    rows = [(i, [float(c) for c in r]) for i, r in enumerate(draw.normal(size=(400, 6)) * np.array([3e4, 900, 30, 1, 0.5, 0.2]))]
    check(rows, result(shipped.createDataFrame(rows, SCHEMA)), 6)


def test_dependent_dimensions_have_no_component(shipped):
    draw = np.random.default_rng(4)
    base = draw.integers(-50, 50, (200, 3)) / 64
    rows = [(i, [float(c) for c in (a, b, c, a, 1.0, a + b)]) for i, (a, b, c) in enumerate(base)]
    check(rows, result(shipped.createDataFrame(rows, SCHEMA)), 3)


def test_sums_beyond_64_bits_stay_exact():
    centre = whitening.Centre(1 << 30, [(1 << 30) * 10**12 + 7, -5])
    x = np.array([[10**12 + 1, 3], [-(10**12), 0]])
    want = [[(1 << 30) * int(a) - s for a, s in zip(row, [(1 << 30) * 10**12 + 7, -5])] for row in x]
    assert centre.scaled(x).tolist() == want
    assert centre.deviations(x) == [d if (d := sum(v * v for v in row)) < 1 << 63 else None for row in want]
    assert centre.centred(x)[0, 0] == float(Fraction(want[0][0], 1 << 30))


def test_solve_right():
    draw = np.random.default_rng(1)
    factor = np.triu(draw.normal(size=(70, 70))) + 9 * np.eye(70)
    rows = draw.normal(size=(11, 70))
    assert np.allclose(whitening.solve_right(rows, factor) @ factor, rows)


def test_odd_tables(shipped):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 0.0]), (6, [-inf, 0.0]), (7, [3e38, -3e38]),
            (8, [1.0, 2.0]), (8, [1.0, 2.0]), (None, [5.0, 1.0]), (9, [0.0, 4.0]), (10, [1.0, 2.0, 3.0]), (11, [])]
    df = shipped.createDataFrame(rows, SCHEMA).selectExpr("*", "vec_id AS component", "1 AS X")
    got = whitening.whiten(df).collect()
    assert {r.vec_id for r in got} == {7, 8, 9, None}  # one vector of width 3 and empty ones have no component
    assert sorted(r.component for r in got if r.vec_id == 8) == [1, 1, 2, 2]
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.filter("vec_id IN (1, 2, 8, 10)")).collect() == []
