"""Shared small inputs of these tests."""

import pathlib
import random
import sys

import pytest

from tidegate.llm import common

sys.path.insert(0, str(pathlib.Path(__file__).parent))

ODD_TEXTS = [None, "", " \n\t ", "one", "ONE", "two words", "a b c d", "a b c d e", "é ß 中文 字 x", "x" * 5000, "w " * 3000,
             "tab\there\r\nline end\x1c!", "a <|endoftext|> b </s> ▁ ▁▁ c", "don't we'll they've I'm", "  lead", "trail  "]


@pytest.fixture(scope="session")
def shipped(spark):
    common.ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd_docs(shipped):
    """Null and odd texts, repeated rows, ties, a null id and columns whose names clash with an operator's."""
    rows = [(i, t, "s0", 1) for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, "one", "s0", 1), (40, "two words", None, 2), (41, None, None, 2), (None, "no id here at all", "s1", 3), (None, None, "s1", 3)]
    return shipped.createDataFrame(rows, "doc_id bigint, text string, source string, _statistics int").selectExpr(
        "*", "1 AS class", "'x' AS tokens", "2 AS block", "doc_id AS id")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def random_docs():
    """(doc_id, text) with exact and near copies and a passage that many share."""
    draw = random.Random(5)
    vocabulary = ["".join(draw.choice("abcdeor") for _ in range(draw.randint(2, 6))) for _ in range(400)]
    passage = [draw.choice(vocabulary) for _ in range(25)]
    rows = []
    for i in range(160):
        body = [draw.choice(vocabulary) for _ in range(draw.randint(3, 120))]
        if i % 4 == 0:
            body[len(body) // 2:len(body) // 2] = passage
        if i % 5 == 1:
            body = list(rows[draw.randrange(len(rows))][1])
            for _ in range(draw.randint(0, 3)):
                body[draw.randrange(len(body))] = draw.choice(vocabulary)
        rows.append((i, body))
    return [(i, " ".join(w.title() if i % 7 == 0 else w for w in body)) for i, body in rows]
