"""Rule ensembles: conjunctive rules from small trees, weighted by a lasso logistic fit.

Everything here works on a bounded sample held in numpy; the result is a plain list of rules
that the operator compiles into a column expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES, DEPTH, BINS, SHRINKAGE, MIN_LEAF = 40, 3, 32, 0.3, 20
PENALTY, STEPS = 2e-3, 400


@dataclass(frozen=True)
class Rule:
    """All conditions hold: (feature, True for > and False for <=, threshold); the weight adds to the log-odds."""

    conditions: tuple[tuple[int, bool, float], ...]
    weight: float


@dataclass(frozen=True)
class Ensemble:
    bias: float
    rules: tuple[Rule, ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for rule in self.rules:
            total += rule.weight * matches(x, rule.conditions)
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def matches(x: np.ndarray, conditions) -> np.ndarray:
    held = np.ones(len(x), bool)
    for feature, above, threshold in conditions:
        held &= (x[:, feature] > threshold) if above else (x[:, feature] <= threshold)
    return held


def _cuts(x: np.ndarray) -> list[np.ndarray]:
    """Candidate thresholds per feature, between neighbouring quantiles and rounded to 9 digits."""
    out = []
    for column in x.T:
        values = np.unique(column)
        middles = (values[1:] + values[:-1]) / 2
        if len(middles) > BINS - 1:
            middles = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1]))
            middles = middles[middles < values[-1]]
        out.append(np.unique(np.round(middles, 9)))
    return out


def _tree(bins: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray) -> tuple[list, np.ndarray]:
    """(conditions of every node but the root, the fitted step for each row) of one regression tree."""
    paths, step = [], np.zeros(len(gradient))

    def grow(rows: np.ndarray, path: tuple, depth: int) -> None:
        if path:
            paths.append(path)
        g, h = gradient[rows].sum(), hessian[rows].sum()
        step[rows] = g / (h + 1.0)
        if depth == DEPTH or len(rows) < 2 * MIN_LEAF:
            return
        best = (1e-6, -1, 0)
        for f, edges in enumerate(cuts):
            if not len(edges):
                continue
            n = np.bincount(bins[rows, f], minlength=len(edges) + 1).cumsum()[:-1]
            gl = np.bincount(bins[rows, f], gradient[rows], len(edges) + 1).cumsum()[:-1]
            hl = np.bincount(bins[rows, f], hessian[rows], len(edges) + 1).cumsum()[:-1]
            gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
            gain[(n < MIN_LEAF) | (n > len(rows) - MIN_LEAF)] = 0
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (float(gain[at]), f, at)
        _, f, at = best
        if f < 0:
            return
        left = bins[rows, f] <= at
        threshold = float(cuts[f][at])
        grow(rows[left], (*path, (f, False, threshold)), depth + 1)
        grow(rows[~left], (*path, (f, True, threshold)), depth + 1)

    grow(np.arange(len(gradient)), (), 0)
    return paths, step


def _lasso(design: np.ndarray, y: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Logistic weights with an absolute penalty by accelerated proximal steps; the bias is free."""
    x = np.hstack([np.ones((len(design), 1)), design])
    shrink = np.full(x.shape[1], penalty)
    shrink[0] = 0
    v = np.random.default_rng(3).normal(size=x.shape[1])
    for _ in range(30):
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v) + 1e-300
    rate = 4 * len(x) / (np.linalg.norm(x @ v) ** 2 + 1e-12)
    w = momentum = np.zeros(x.shape[1])
    t = 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ momentum, -500, 500)))
        moved = momentum - rate * (x.T @ (p - y)) / len(x)
        new = np.sign(moved) * np.maximum(np.abs(moved) - rate * shrink, 0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum, w, t = new + (t - 1) / t_next * (new - w), new, t_next
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> Ensemble:
    """Fit on rows of statistics and 0/1 labels; with fewer than two labels a constant share."""
    positive = float(y.sum())
    if not len(y) or positive in (0.0, float(len(y))):
        share = (positive + 1) / (len(y) + 2)
        return Ensemble(float(np.log(share / (1 - share))), ())
    cuts = _cuts(x)
    bins = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T)], 1)
    odds = np.full(len(y), np.log(positive / (len(y) - positive)))
    found: dict[tuple, None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-odds))
        paths, step = _tree(bins, cuts, y - p, p * (1 - p))
        odds = odds + SHRINKAGE * step
        found.update(dict.fromkeys(paths))
    conditions, columns, seen = [], [], set()
    for path in found:
        held = matches(x, path)
        key = held.tobytes()
        if key not in seen and 0 < held.sum() < len(held):
            seen.add(key)
            conditions.append(path)
            columns.append(held)
    if not columns:
        return Ensemble(float(np.log(positive / (len(y) - positive))), ())
    bias, weights = _lasso(np.stack(columns, 1).astype(np.float64), y.astype(np.float64), penalty)
    kept = [Rule(c, round(float(w), 9)) for c, w in zip(conditions, weights) if abs(w) > 1e-6]
    return Ensemble(round(bias, 9), tuple(kept))
