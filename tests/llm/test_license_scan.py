"""License wordings against plain loops over words."""

import re

import numpy as np
import pytest

from tidegate.llm import license_scan
from tidegate.llm.license_texts import BASE, NAMES, NOTICES, TEMPLATES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def base_of(text):
    words, found = words_of(text), []
    for template in BASE:
        phrase = template.text.split()
        found += [(i, template.label) for i in range(len(words)) if words[i:i + len(phrase)] == phrase]
    places = [i for i, _ in found]
    return (len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found})))


def scanned(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").selectExpr("*", "1 AS class_a", "'x' AS spans", "2 AS width")
    rows = license_scan.scan_licenses(docs.repartition(3), **options).collect()
    assert len(rows) == len(texts)
    return sorted(rows, key=lambda r: r.doc_id)


MIT = NOTICES[0].text
EDITED = MIT.replace("free of charge, ", "").replace("this software", "this fine software").replace("restriction", "restraint")
TEXTS = [
    None, "", "MIT License", "mit  LICENSE mit-license mit license.", "MIT License x\u0085y", "the mit, license general public license General/Public\nLicense",
    "general public", "public license general public license license", "Ümit license", "mitlicense mit1 license", "apache\0license",
    "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", MIT, EDITED, f"before it {EDITED} after it", MIT[:len(MIT) // 3],
    " ".join(reversed(MIT.split())), f"{MIT} {MIT}", "filler " * 70_000 + "apache license", "mit license " * 40_000,
    "This program is free software; you can redistribute it and modify it under the terms of the GNU General Public License as published "
    "by the Free Software Foundation; either version 2 of the License, or any later version"]


def test_base_equals_brute_force(shipped, random_docs):
    texts = TEXTS + [t for _, t in random_docs]
    for row, text in zip(scanned(shipped, texts), texts):
        assert tuple(row[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == base_of(text)
        assert set(filter(None, row.base_labels.split(","))) <= set(filter(None, row.labels.split(",")))
        assert 0 <= row.score <= 1 and (row.score > 0) == bool(row.labels)


def test_notices_with_edits(shipped):
    got = {t: (r.labels, len(r.spans)) for t, r in zip(TEXTS, scanned(shipped, TEXTS))}
    assert got["Licensed under CC BY-NC 4.0."] == ("cc-by-nc", 1)
    assert got[MIT] == ("mit", 1) and got[EDITED] == ("mit", 1) and got[f"before it {EDITED} after it"] == ("mit", 1)
    assert got[f"{MIT} {MIT}"] == ("mit", 2)
    assert got[MIT[:len(MIT) // 3]] == ("", 0) and got[" ".join(reversed(MIT.split()))] == ("", 0)
    assert got[TEXTS[-1]][0] == "gpl"


def test_every_template_finds_itself(shipped):
    rows = scanned(shipped, [f"so it says {t.text} and no more" for t in TEMPLATES])
    for number, (template, row) in enumerate(zip(TEMPLATES, rows)):
        span = [s for s in row.spans if s.template == number]
        assert [(s.first_word, s.last_word, s.share) for s in span] == [(3, 2 + len(words_of(template.text)), 1.0)]


def test_spans_where_the_words_stand(shipped):
    text = f"one two {NOTICES[1].text.replace('may not use', 'may never use')} three {NAMES[2].text}"
    (row,) = scanned(shipped, [text])
    assert [(s.label, s.first_word) for s in row.spans] == [("apache", 2), ("apache", 5), ("mpl", 2 + len(words_of(NOTICES[1].text)) + 1)]


def test_small_slices_and_plain_joins_change_nothing(shipped, monkeypatch):
    want = scanned(shipped, TEXTS[:19])
    monkeypatch.setattr(license_scan, "SLICE_WORDS", 7)
    monkeypatch.setattr(license_scan, "GRAM_BYTES", 0)
    assert scanned(shipped, TEXTS[:19]) == want


def test_longest_common_subsequence():
    draw = np.random.default_rng(2)

    def slow(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    for _ in range(30):
        a, b = (draw.integers(0, 5, draw.integers(0, 14)) for _ in range(2))
        assert license_scan.common_in_order(a, b) == slow(a, b)


def test_odd_tables(shipped, odd_docs, no_docs):
    rows = license_scan.scan_licenses(odd_docs).collect()
    assert len(rows) == odd_docs.count() and sum(r.doc_id is None for r in rows) == 2
    assert license_scan.scan_licenses(no_docs).collect() == []
    with pytest.raises(ValueError):
        license_scan.wordings([NOTICES[0]._replace(text="three words only")])
