"""Operator 1: the compiled expression equals the rules, and held-out labels are met."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegate.llm import quality, rules, scan


def test_rules_find_a_conjunction():
    draw = np.random.default_rng(1)
    x = draw.random((3000, 4))
    y = ((x[:, 0] > 0.4) & (x[:, 2] <= 0.7)).astype(float)
    model = rules.fit(x[:2000], y[:2000])
    assert (((model.score(x[2000:]) >= 0.5) == y[2000:]).mean()) > 0.97
    assert 0 < len(model.rules) < 60
    assert rules.fit(x[:2000], y[:2000]) == model
    assert len(rules.fit(x[:2000], y[:2000], penalty=10.0).rules) == 0


@pytest.mark.parametrize("y, share", [([], 0.5), ([1.0, 1.0], 0.75), ([0.0], 1 / 3)])
def test_too_few_labels(y, share):
    model = rules.fit(np.zeros((len(y), 3)), np.array(y))
    assert model.rules == () and model.score(np.zeros((1, 3)))[0] == pytest.approx(share)


def test_equal_statistics_for_both_labels():
    model = rules.fit(np.ones((100, 3)), np.array([0.0, 1.0] * 50))
    assert model.score(np.ones((1, 3)))[0] == pytest.approx(0.5)


def test_statistics_of_small_texts():
    texts = ["", "a", "AB cd! EF\n\nAB cd! EF\n", "x||y 12 é", "!!! a!!"]
    (_, _, piece), = scan.text_chunks(pa.array(texts))
    got = {n: c.tolist() for n, c in zip(quality.STATISTICS, quality.statistics(piece).T)}
    assert got["bytes"] == [0, 1, 21, 10, 7] and got["words"] == [0, 1, 6, 3, 2]
    assert got["lines"] == [0, 1, 3, 1, 1] and got["distinct_words"][2] == 0.5 and got["distinct_lines"][2] == pytest.approx(2 / 3)
    assert got["upper_word_share"][2] == pytest.approx(4 / 6) and got["word_mark_share"][2] == pytest.approx(2 / 6)
    assert got["repeated_mark_share"][3:] == [0.1, pytest.approx(3 / 7)] and got["longest_word"] == [0, 1, 3, 4, 3]


def test_column_equals_rules(odd_docs, no_docs):
    model = rules.Ensemble(0.5, (rules.Rule(((0, True, 3.0), (1, False, 4.0)), 1.25), rules.Rule(((2, False, 2.0),), -2.0)))
    rows = quality.score(odd_docs, model).collect()
    texts = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in odd_docs.collect())
    pieces = list(scan.text_chunks(pa.array([t for _, _, t in texts])))
    want = np.concatenate([model.score(quality.statistics(p)) for _, _, p in pieces])
    assert sorted(r.score for r in rows) == pytest.approx(sorted(want))
    assert all(r.predicted == int(r.score >= 0.3) and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    kept = quality.keep_good(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r.predicted for r in rows)
    assert quality.score(no_docs, model).collect() == [] and quality.keep_good(no_docs, model).collect() == []


def test_learning_skips_what_it_may_not_see(shipped, odd_docs):
    labels = shipped.createDataFrame([(0, None), (1, 1), (1, 0), (None, 1), (2, 1), (2, 1), (777, 0)], "doc_id bigint, quality int")
    model = quality.learn(odd_docs, labels)
    seen = [i for i in (2,) if zlib.crc32(str(i).encode()) % 5]
    assert model.rules == () and model.score(np.zeros((1, 20)))[0] == pytest.approx((len(seen) + 1) / (len(seen) + 2))
    assert quality.learn(odd_docs, labels.limit(0)).rules == ()


def test_repeated_ids_teach_once(shipped, monkeypatch):
    seen = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, "word " * (i + 1)) for i in seen] + [(seen[0], f"many {k} rows of one id") for k in range(500)]
    frame = lambda r: shipped.createDataFrame(r, "doc_id bigint, text string")
    labels = shipped.createDataFrame([(i, i % 2) for i in seen], "doc_id bigint, quality int")
    taught = []
    monkeypatch.setattr(rules, "fit", lambda x, y: taught.append((x.tolist(), y.tolist())))
    quality.learn(frame(rows), labels)
    quality.learn(frame(rows[::-1]), labels)
    assert len(taught[0][1]) == len(seen) and taught[0] == taught[1]


def test_held_out_labels(shipped, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    docs, labels = (shipped.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(docs, quality.learn(docs, labels)).filter("held_out").join(labels, "doc_id")
    right = scored.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.98
