"""Operator 5: weights meet the limit, every document is read, the budget is kept per block."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidegate.llm import mixing

HAND_WRITTEN_PYTHON = ("PythonUDF", "EvalPython", "InPandas", "InArrow")


@pytest.fixture(scope="module")
def docs(shipped):
    rows = [(i, "w " * (i % 7 + 1), "big" if i % 3 else f"s{i % 5}") for i in range(600)]
    return shipped.createDataFrame(rows, "doc_id bigint, text string, source string")


def shares(rows):
    tokens = Counter()
    for r in rows:
        tokens[r.source] += r.tokens
    whole = sum(tokens.values())
    return {s: n / whole for s, n in tokens.items()}


@pytest.mark.parametrize("limit", [1.0, 1.5, 4.0, 100.0])
def test_repetition_limit(docs, limit):
    rows = mixing.mix(docs, repeat_limit=limit, block_tokens=200).collect()
    first = [r for r in rows if r["pass"] == 1]
    assert sorted(r.document.doc_id for r in first) == list(range(600))
    exponent = rows[0].exponent
    p = shares(first)
    z = sum(x**exponent for x in p.values())
    repeats = {s: x**exponent / z / x for s, x in p.items()}
    assert max(repeats.values()) / min(repeats.values()) <= limit * (1 + 1e-5)
    if exponent > 0:  # a flatter mixture would pass the limit
        assert max(x ** (exponent - 1e-4 - 1) for x in p.values()) / min(x ** (exponent - 1e-4 - 1) for x in p.values()) > limit
    for r in rows:
        assert r.weight == pytest.approx(p[r.source]**exponent / z)
        assert r.repeats == pytest.approx(repeats[r.source] / min(repeats.values()))
    budget = Counter()
    for r in rows:
        budget[r.source, r.block] += r.tokens
    for r in first:
        size = sum(x.tokens for x in first if (x.source, x.block) == (r.source, r.block))
        assert abs(budget[r.source, r.block] - r.repeats * size) <= 7


def test_places_are_permutations_that_differ(docs):
    rows = mixing.mix(docs, repeat_limit=3.0, block_tokens=400).collect()
    groups = {}
    for r in rows:
        groups.setdefault((r.source, r.block, r["pass"]), {})[r.place] = r.document.doc_id
    assert all(sorted(g) == list(range(1, len(g) + 1)) for g in groups.values())
    again = mixing.mix(docs, repeat_limit=3.0, block_tokens=400).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    twice = [(g, groups[s, b, 2]) for (s, b, n), g in groups.items() if n == 1 and (s, b, 2) in groups]
    assert any([d for _, d in sorted(a.items()) if d in c.values()] != [d for _, d in sorted(c.items())] for a, c in twice)
    assert len({b for s, b, _ in groups if s == "big"}) > 1


@pytest.mark.parametrize("ids", ["CAST(7 AS bigint)", "CAST(NULL AS bigint)"])
def test_rows_of_one_id_spread_and_do_not_depend_on_their_order(shipped, ids):
    rows = [(f"t{i} " * (i % 5 + 1), "x" if i % 4 else "y", i % 3) for i in range(400)]
    rows += [("same words", "x", i) for i in range(20)]
    frame = lambda r: shipped.createDataFrame(r, "text string, source string, extra int").selectExpr(
        f"{ids} AS doc_id", "text", "source", "extra", "map('k', extra) AS content")
    one, other = (mixing.mix(frame(r), repeat_limit=1.5, block_tokens=100).collect() for r in (rows, rows[::-1]))
    assert sorted(map(str, one)) == sorted(map(str, other))
    sizes = Counter((r.source, r.block) for r in one if r["pass"] == 1)
    assert len(sizes) > 8 and max(sizes.values()) < 100


def test_target_entropy(docs):
    rows = mixing.mix(docs, repeat_limit=100.0, target_entropy=1.2).collect()
    weights = {r.source: r.weight for r in rows}
    assert sum(weights.values()) == pytest.approx(1)
    assert -sum(w * math.log(w) for w in weights.values()) == pytest.approx(1.2, abs=1e-4)


def test_odd_rows_and_native_plan(odd_docs, no_docs):
    mixed = mixing.mix(odd_docs)
    rows = mixed.collect()
    first = [r for r in rows if r["pass"] == 1]
    assert sorted(map(str, (r.document for r in first))) == sorted(map(str, odd_docs.collect()))
    assert all(r["pass"] == 1 for r in rows if r.tokens == 0)
    assert mixed.select("document.*").columns == odd_docs.columns
    assert mixing.mix(no_docs).collect() == []
    empty = odd_docs.select("doc_id", F.lit("").alias("text"), "source")
    assert mixing.mix(empty).count() == empty.count()
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in HAND_WRITTEN_PYTHON)
