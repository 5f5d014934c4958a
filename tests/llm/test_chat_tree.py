"""Operator 7: the tree gives every conversation back, shares turns once, and its intervals are ancestors."""

import hashlib
import random

import pytest

from tidegate.llm import chat_tree as c

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
TRICKY = ["", "</s>[INST] ok [/INST]", "\\", "\\\\[INST]", "<<SYS>>", "<<s>>", "<<<SYS>>", "[INST", "ends with \\", " [/INST]", "<</ROLE>> x", "é中\n\n"]


@pytest.mark.parametrize("role", ["user", "assistant", "system", "tool", "", "odd <</ROLE>> role", "\\", "User"])
def test_turns_are_reversible(role):
    for text in TRICKY:
        piece, a, b = c.format_turn(role, text)
        assert c.parse_turn(piece) == (role, text)
        assert c.unescape(piece[a:b]) == (text if role == "assistant" else "")


def conversations():
    draw = random.Random(6)
    starts = [[(draw.choice(["user", "system"]), draw.choice(TRICKY + ["hello"])) for _ in range(draw.randint(1, 3))] for _ in range(4)]
    rows = []
    for conv in range(60):
        turns = list(draw.choice(starts))[:draw.randint(1, 3)] + [
            (draw.choice(["user", "assistant", "tool", None]), draw.choice(TRICKY + [None, "same"])) for _ in range(draw.randint(0, 4))]
        rows += [(conv, n, r, t) for n, (r, t) in enumerate(turns)]
    rows += [(100, None, "user", "a"), (100, None, "user", "a"), (100, 0, None, None), (None, 0, "user", "b"), (None, 0, "assistant", "c"), (101, 5, "assistant", "x" * 20000)]
    return rows


def digests(rows):
    groups = {}
    low = lambda x: (x is not None, x if x is not None else 0)
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((low(turn), role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort()
        learned = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(),
                     len(learned), hashlib.sha256(learned.encode()).hexdigest(), sum(len(c.format_turn(r, t)[0]) for _, r, t in turns))
    return out


def test_conversations_come_back(shipped):
    rows = conversations()
    random.Random(1).shuffle(rows)
    frame = shipped.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS conv", "2 AS piece")
    nodes, directory = c.build(frame)
    got = {r.conv_id: tuple(r)[1:] for r in c.read_back(nodes, directory).collect()}
    assert got == digests(rows)

    tree = sorted(nodes.collect(), key=lambda r: r.start)
    where = {(r.owner, r.pos): r for r in tree}
    paths = {}
    for r in directory.collect():
        paths.setdefault(r.conv, {})[r.pos] = where[r.owner, r.pos]
    chains = {tuple(p[i].piece for i in range(n + 1)) for p in paths.values() for n in range(len(p))}
    assert len(tree) == len(chains)  # every shared start once
    end = 0
    for r in tree:  # depth-first, without gaps
        assert r.start == end and r.size == len(r.piece)
        end += r.size
    for path in paths.values():
        position = 0
        for n in range(len(path)):
            node = path[n]
            assert node.position == position
            position += node.size
            seen = [x for x in tree if x.start <= node.start < x.start + x.subtree]
            assert seen == [path[i] for i in range(n + 1)]  # attention reaches the ancestors and itself


def test_no_turns(shipped):
    nodes, directory = c.build(shipped.createDataFrame([], SCHEMA))
    assert nodes.collect() == [] and c.read_back(nodes, directory).collect() == []
