"""Aligned tokens against a plain walk over byte ranges, and the counts of linked ids against a loop."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tidegate.llm import token_alignment
from tidegate.llm.common import tokenizer_path
from tidegate.llm.diagonals import align
from tidegate.llm.token_bytes import byte_alphabet

PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "a", "  two  spaces\n\nand lines\t", "Ünïcödé 中文字 🙂🙂 x", "<|endoftext|> and </s> <unk> <0x41>", "▁ under ▁▁ score",
    "nul \0 byte", "don't we'll 12345 67 ...!!!", "x" * 700, " " * 90 + "end", "the same text", "the same text", "é" * 50, "tab\there\r\nline\x1c! z q"]


def brute(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(PATHS[0]), SentencePieceProcessor(model_file=PATHS[1])
    first.encode_special_tokens = True
    alphabet, rows, linked = byte_alphabet(), [], []
    for text in texts:
        tokens = [], []
        if text:
            whole = (" " + text).encode()
            a = [(i, bytes(alphabet[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode())
                 for i in second.encode(text)]
            if b"".join(t for _, t in a) == whole == b"".join(t for _, t in b):
                tokens = a, b
        ranges = []
        for side in tokens:
            at, own = 0, []
            for i, raw in side:
                own.append((i, at, at + len(raw)))
                at += len(raw)
            ranges.append(own)
        both = {e for _, _, e in ranges[0]} & {e for _, _, e in ranges[1]}
        groups, last = [], 0
        for end in sorted(both):
            groups.append("|".join(",".join(str(i) for i, s, e in own if last <= s and e <= end) for own in ranges))
            last = end
        links = [(i, j) for i, s, e in ranges[0] for j, t, f in ranges[1] if s < f and t < e]
        linked.append(links)
        rows.append([len(ranges[0]), len(ranges[1]), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""])
    count, best = Counter(p for links in linked for p in set(links)), defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return [(*row[:4], sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), row[4]) for row, links in zip(rows, linked)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(1, 60)), min_size=2, max_size=2), st.integers(1, 7))
def test_align_equals_all_overlaps(ends, lane):
    a, b = (np.array(sorted(e | {61}), np.int64) for e in ends)
    found = align(a, b, lane)
    common = sorted(set(a) & set(b))
    assert a[found.cut_a].tolist() == common == b[found.cut_b].tolist()
    begin_a, begin_b = np.append(0, a[:-1]), np.append(0, b[:-1])
    links = sorted((i, j) for i in range(len(a)) for j in range(len(b)) if begin_a[i] < b[j] and begin_b[j] < a[i])
    assert sorted(zip(found.link_a.tolist(), found.link_b.tolist())) == links


@pytest.mark.parametrize("hot", [token_alignment.HOT_PAIRS, 40, 0])
def test_equals_brute_force(shipped, random_docs, hot):
    texts = TEXTS + [t for _, t in random_docs[:60]]
    docs = shipped.createDataFrame(list(enumerate(texts)), "doc_id int, text string").selectExpr("*", "1 AS row", "'x' AS pairs", "2 AS n_a")
    got = token_alignment.align_tokens(docs.repartition(3), *PATHS, hot_pairs=hot).collect()
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert [tuple(r[n] for n in names) for r in sorted(got, key=lambda r: r.doc_id)] == brute(texts)


def test_odd_tables(shipped, odd_docs, no_docs):
    got = token_alignment.align_tokens(odd_docs, *PATHS)
    assert got.count() == odd_docs.count()
    assert got.filter("doc_id IS NULL").count() == 2
    assert got.filter("n_a = 0 AND (n_links > 0 OR groups_sha256 <> '' OR count_sum > 0)").isEmpty()
    assert got.filter("doc_id = 3").distinct().count() == 1 and got.filter("doc_id = 3").count() == 2
    assert token_alignment.align_tokens(no_docs, *PATHS).collect() == []


def test_chunks_change_nothing(random_docs):
    sides = token_alignment._side(token_alignment.ByteLevelSide, PATHS[0]), token_alignment._side(token_alignment.PieceSide, PATHS[1])
    texts = pa.array([t for _, t in random_docs[:40]])
    whole = token_alignment._aligned(texts, *sides)
    parts = [token_alignment._aligned(texts.slice(i, 1), *sides) for i in range(40)]
    for column in range(7):
        assert whole[column].to_pylist() == [p[column].to_pylist()[0] for p in parts]
