"""Operator 2: ids equal the library's, files give them back."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidegate.llm import scan, token_ids, wavelet
from tidegate.llm.common import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


def library_ids(text):
    return token_ids.coder(PATH).tokenizer.encode(text or "", add_special_tokens=False).ids


def expected(rows):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = library_ids(text) + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_pieces_give_the_ids_of_whole_texts():
    draw = random.Random(3)
    letters = list("ab,.'st \n\t \r!1é |ñ’\x1cß\x01ll re ve 中文字 <>") + ["<|endoftext|>", "'s", "'ll", " '", " ", " "]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(4000)]
    coder = token_ids.PieceCoder(PATH)
    for a, b, piece in scan.text_chunks(pa.array(texts), 5000):
        ids, counts = coder.encode(piece)
        ends = np.concatenate([[0], counts.cumsum()])
        for i in range(a, b):
            assert ids[ends[i - a]:ends[i - a + 1]].tolist() == library_ids(texts[i]), repr(texts[i])


def test_pieces_survive_a_full_memory(monkeypatch):
    monkeypatch.setattr(token_ids, "CACHE_WORDS", 50)
    coder = token_ids.PieceCoder(PATH)
    for text in ("one two three four five six " * 3, " ".join(map(str, range(200))), "one two nine"):
        (_, _, piece), = scan.text_chunks(pa.array([text]))
        assert coder.encode(piece)[0].tolist() == library_ids(text)


@pytest.mark.parametrize("values", [[], [0], [5], [1, 1, 1], [0, 65535, 7, 7, 70000, 3]])
def test_wavelet_matrix_edges(values):
    matrix = wavelet.WaveletMatrix(wavelet.encode(np.array(values, np.uint32), np.array([len(values)])))
    assert matrix.all_ids().tolist() == values
    assert [matrix.access(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        matrix.access(len(values))


def test_wavelet_matrix_rank_and_select():
    ids = np.random.default_rng(1).integers(0, 50257, 3000)
    ids[::7] = 5
    matrix = wavelet.WaveletMatrix(wavelet.encode(ids, np.array([1000, 3000])))
    assert matrix.ends.tolist() == [1000, 3000]
    assert (matrix.all_ids() == ids).all()
    for value in (5, int(ids[11]), 60000, 1 << 20):
        places = np.flatnonzero(ids == value)
        assert matrix.count(value) == len(places)
        for position in (0, 1, 999, 3000):
            assert matrix.rank(value, position) == (places < position).sum()
        assert [matrix.select(value, n) for n in range(len(places))][:20] == places[:20].tolist()
        assert matrix.select(value, len(places)) == -1


def test_shards_give_every_document_back(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = token_ids.read_token_shards(token_ids.write_token_shards(odd_docs, PATH, shard_tokens=700)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(rows)


def test_no_documents(no_docs):
    assert token_ids.read_token_shards(token_ids.write_token_shards(no_docs, PATH)).collect() == []
