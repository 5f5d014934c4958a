"""Operator 9: classes equal brute force over whole sets, whatever the order of shingles."""

import numpy as np
import pyarrow as pa
import pytest

from tidegate.llm import metric_join, shingles
from tests_llm_inputs import words


def text_set(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def brute(rows):
    sets = [text_set(t) for _, t in rows]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if None not in (rows[a][0], rows[b][0]) and sets[a] and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                p, q = sorted((find(rows[a][0]), find(rows[b][0])))
                parent[q] = p
    return sorted((-1 if i is None else i, len(s), -1 if i is None else find(i)) for (i, _), s in zip(rows, sets))


def classes(frame, **options):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id)
                  for r in metric_join.jaccard_classes(frame, **options).collect())


@pytest.mark.parametrize("hot_local", [4, 2, 10_000])
def test_equals_brute_force(shipped, random_docs, monkeypatch, hot_local):
    monkeypatch.setattr(metric_join, "HOT_LOCAL", hot_local)
    frame = shipped.createDataFrame(random_docs, "doc_id bigint, text string")
    want = brute(random_docs)
    assert any(i != c for i, _, c in want)
    assert classes(frame) == want


def test_a_large_group_of_near_copies(shipped):
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[:i % 50] + [f"x{i}"] + base[i % 50 + 1:])) for i in range(250)] + [(500 + i, " ".join(base)) for i in range(200)]
    rows += [(900 + i, " ".join(base[:30] + [f"y{i}z{k}" for k in range(30)])) for i in range(60)]
    assert classes(shipped.createDataFrame(rows, "doc_id bigint, text string")) == brute(rows)


def crowd(n):
    """Copies of one text of 200 words, each with up to six words of its own; copies far from each other are not linked."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(n):
        text = list(base)
        for at in rng.choice(200, rng.integers(0, 7), replace=False):
            text[at] = f"x{i}y{at}"
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("block", [16, 4096])
def test_a_crowd_cut_into_blocks(shipped, monkeypatch, block):
    monkeypatch.setattr(metric_join, "BLOCK_MEMBERS", block)
    rows = crowd(90) + [(1000 + i, text.replace("w1 ", "v1 v2 ")) for i, text in crowd(40)]
    assert classes(shipped.createDataFrame(rows, "doc_id bigint, text string")) == brute(rows)


def test_pairs_of_a_doubled_crowd_about_double(shipped, monkeypatch):
    pairs = []
    near = metric_join._checked
    monkeypatch.setattr(metric_join, "_checked", lambda found, *rest: (pairs.append(found.count()), near(found, *rest))[1])
    for n in (300, 600):  # from 150 to 300 a second pivot comes in, which is a step of its own
        metric_join.jaccard_classes(shipped.createDataFrame(crowd(n), "doc_id bigint, text string")).count()
    assert sum(pairs[:2]) > 50
    assert sum(pairs[2:]) <= 2.5 * sum(pairs[:2]), pairs


def test_links_at_the_threshold(shipped):
    base = [f"w{i}" for i in range(44)]  # 40 shingles
    rows = [(i, " ".join(base[:44 - i])) for i in range(12)] + [(50, " ".join(base + ["more"] * 3))]
    assert classes(shipped.createDataFrame(rows, "doc_id bigint, text string")) == brute(rows)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert classes(odd_docs) == brute(rows)
    assert classes(no_docs) == []
    kept = metric_join.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 2 and ids.count(3) == 1 and 4 not in ids
    components = {i: c for i, _, c in brute(rows)}
    assert sorted(i for i in ids if i is not None) == sorted({i for i, c in components.items() if i == c and i >= 0})
    assert metric_join.keep_one(no_docs).collect() == []


def test_rows_that_share_an_id_are_judged_by_their_texts(shipped):
    texts = ["the first text of three that differ altogether", "a second one that has nothing in common with it",
             "and some third words which nobody else has written", "A second one that has NOTHING in common with it"]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (None, texts[3]), (None, texts[2]), (1, texts[0]), (None, None), (None, None), (7, "")]
    kept = metric_join.keep_one(shipped.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept if r.text) == [("1", texts[1]), ("1", texts[0]), ("2", texts[2])]
    assert sorted(str(r.doc_id) for r in kept if not r.text) == ["7", "None"]


def test_sets_equal_brute_force(random_docs):
    column = [t for _, t in random_docs] + ["", " ", "a", "a a a a a a", "b " * 300]
    for a, b, piece in shingles.pieces(pa.array(column)):
        sets = shingles.sets_of(piece)
        assert sets.sizes.tolist() == [len(text_set(t)) for t in column[a:b]]
        parts = [set(sets.keys[p:q].tolist()) for p, q in zip(sets.bounds[:-1], sets.bounds[1:])]
        for i in range(0, b - a, 7):
            for j in range(0, b - a, 11):
                assert len(parts[i] & parts[j]) == len(text_set(column[a + i]) & text_set(column[a + j]))


def test_windows_meet_for_every_link():
    draw = np.random.default_rng(2)
    for _ in range(200):
        n = int(draw.integers(1, 60))
        one = np.sort(draw.choice(1000, n, replace=False)).astype(np.uint64)
        drop = int(draw.integers(0, n // 5 + 1))
        two = np.sort(np.concatenate([draw.choice(one, n - drop, replace=False), draw.choice(np.arange(2000, 3000), drop, replace=False).astype(np.uint64)])).astype(np.uint64)
        both = shingles.Sets(np.concatenate([one, two]), np.array([0, len(one), len(one) + len(two)]))
        hot = np.sort(draw.choice(1000, 200, replace=False)).astype(np.uint64)
        keys, owner, _ = shingles.windows(both, 80, hot, draw.integers(1, 50, 200))
        if shingles.linked(one, two, 80):
            assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


@pytest.mark.parametrize("block", [metric_join.BLOCK_SHINGLES, 400])
def test_links_equal_brute_force(shipped, random_docs, monkeypatch, block):
    monkeypatch.setattr(metric_join, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(metric_join, "BLOCK_SETS", 8)
    monkeypatch.setattr(metric_join, "COLUMNS", 64)
    base = [f"w{i}" for i in range(60)]
    rows = [(1000 + i, " ".join(base[:i % 50] + [f"x{i}"] + base[i % 50 + 1:])) for i in range(60)] + random_docs
    rows += [(2000 + i, " ".join(base[:40 + i // 2])) for i in range(40)] + [(3000, None), (3001, "")]
    frame = shipped.createDataFrame(rows, "doc_id bigint, text string")
    links, members = metric_join.jaccard_links(frame)
    first = {}
    for i, text in rows:
        key = text_set(text or "")
        first[key] = min(i, first.get(key, i))
    sets = sorted(((i, key) for key, i in first.items() if key), key=lambda x: x[0])
    want = {(i, j): len(a & b) for n, (i, a) in enumerate(sets) for j, b in sets[n + 1:] if 100 * len(a & b) >= 80 * len(a | b)}
    assert len(want) > 500
    got = [((min(r.doc_a, r.doc_b), max(r.doc_a, r.doc_b)), r.n_shared) for r in links.collect()]
    assert len(got) == len(want) and dict(got) == want
    degree = {i: sum(i in pair for pair in want) for i, _ in sets}
    found = members.collect()
    assert sorted((r.doc_id, r.n_links) for r in found) == sorted((i, degree.get(first[text_set(t or "")], 0)) for i, t in rows)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == classes(frame)


def test_links_of_odd_rows(odd_docs, no_docs):
    links, members = metric_join.jaccard_links(odd_docs)
    assert members.count() == odd_docs.count()
    assert all(r.a < r.b for r in links.collect())
    links, members = metric_join.jaccard_links(no_docs)
    assert links.collect() == [] and members.collect() == []
