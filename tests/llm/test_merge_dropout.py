"""Operator 8: without dropout the library's pieces, with it varied ones; always lossless."""

import random

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F

from tidegate.llm import merge_dropout as m
from tidegate.llm import queries, scan
from tidegate.llm.common import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")


def texts(n=1500):
    draw = random.Random(2)
    letters = list("ab,.'st \n\t  \r!1é  |ñ’\x1cß\x01ll re ve 中文字 the ing ")
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, 80))) for _ in range(n)] + [
        "x" * 500, "", "the" * 100, " " * 40, "\n", "a;\r\n"]


def split(codec, column, keys=None):
    out = []
    for a, b, piece in scan.text_chunks(pa.array(column), 4000):
        own = np.arange(a, b).astype(np.uint64) if keys is None else keys[a:b]
        ids, counts = codec.encode(piece, scan.mix(own))
        data, bounds = codec.decode_all(ids, counts)
        assert data.tobytes() == piece.data.tobytes() and (bounds == piece.bounds).all()
        ends = np.concatenate([[0], counts.cumsum()])
        out += [ids[p:q].tolist() for p, q in zip(ends[:-1], ends[1:])]
    return out


def test_without_dropout_equals_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    column = texts()
    assert split(m.Codec(PATH, 1, 0.0, 1), column) == library.encode(column)


def test_dropout_is_seeded_varied_and_lossless():
    column = [*texts(300), "▁ stays ▁▁ itself", "repeated words " * 200]
    one, same, other = (split(m.Codec(PATH, seed, 0.3, 8), column) for seed in (1, 1, 2))
    assert one == same != other
    codec = m.Codec(PATH, 1, 0.3, 8)
    forms = {tuple(codec.segment(" repeated", v)) for v in range(8)}
    assert len(forms) > 1
    assert all(codec.decode(np.array(form)) == "repeated" for form in forms)
    assert sum(map(len, one)) > sum(map(len, split(m.Codec(PATH, 1, 0.0, 1), column)))


def test_full_dropout_merges_nothing():
    assert m.Codec(PATH, 1, 1.0, 1).segment(" the", 0) == [int(m.Codec(PATH, 1, 0.0, 1).chars[ord(c)]) for c in " the"]


def test_matrix_and_heap_agree():
    draw = random.Random(4)
    codec = m.Codec(PATH, 3, 0.2, 8)
    words = [" " * draw.randint(0, 3) + "".join(draw.choice("abcdetinghsé中▁") for _ in range(draw.randint(1, 30))) for _ in range(1500)]
    variants = np.arange(len(words)) % 8
    flat, counts = codec._learn(words, variants)
    ends = np.concatenate([[0], counts.cumsum()])
    for i, word in enumerate(words):
        assert flat[ends[i]:ends[i + 1]].tolist() == codec.segment(word, int(variants[i]))


def test_documents(odd_docs, no_docs):
    rows = m.encode_documents(odd_docs, PATH).collect()
    assert len(rows) == odd_docs.count() and all(r.lossless and len(r.ids) == r.n_tokens for r in rows)
    codec = m.Codec(PATH)
    assert sorted((r.doc_id or -1, codec.decode(np.array(r.ids, np.int64))) for r in rows) == sorted(
        (r.doc_id or -1, r.text or "") for r in odd_docs.collect())
    twice = [r.ids for r in rows if r.doc_id == 3]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert m.encode_documents(no_docs, PATH).collect() == []


def test_every_occurrence_draws_for_itself():
    codec = m.Codec(PATH, 5, 0.1)
    text = " international" * 3000
    ids = split(codec, [text], np.zeros(1, np.uint64))[0]
    number = np.arange(3000, dtype=np.uint64)
    drawn = scan.mix(scan.mix(np.zeros(1, np.uint64)) + number * np.uint64(m._SALT[1]) + np.uint64(5))
    forms = [codec.segment(" " * (1 + (i == 0)) + "international", int(v)) for i, v in enumerate(drawn)]
    assert ids == [x for form in forms for x in form]
    assert len({tuple(form) for form in forms}) > 8


def test_readings_of_a_document_differ(shipped):
    text = "several readings of the international encyclopedia " * 20
    rows = shipped.createDataFrame([(1, text)] * 3 + [(2, text)], "doc_id bigint, text string")
    got = [(r.doc_id, tuple(r.ids)) for r in m.encode_documents(m.readings(rows), PATH, reading="reading").collect()]
    assert len(set(got)) == 4 and len({ids for _, ids in got}) == 4


def test_ids_are_read_back_and_decoded(shipped, odd_docs, no_docs, sf_dir):
    encoded = m.encode_documents(odd_docs, PATH)
    assert sorted((r.doc_id or -1, r.text) for r in m.decode_documents(encoded, PATH).collect()) == sorted(
        (r.doc_id or -1, r.text or "") for r in odd_docs.collect())
    assert m.decode_documents(m.encode_documents(no_docs, PATH), PATH).collect() == []
    wrong = encoded.withColumn("ids", F.expr("IF(doc_id = 3, slice(ids, 1, 0), ids)"))
    assert {r.doc_id for r in m.read_back(wrong, PATH).collect() if not r.lossless} == {3}
    codec = m.Codec(PATH)
    texts = {r.doc_id: r.text for r in shipped.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op8_merge_dropout(shipped, sf_dir).collect()
    assert len(rows) == len(texts) and all(r.lossless and codec.decode(np.array(r.ids, np.int64)) == texts[r.doc_id] for r in rows)


def test_the_memory_of_pieces_adds_without_copying_all_of_it():
    from tidegate.llm.pieces import IdStore

    store, copies = IdStore(10_000), set()
    ids_of = lambda keys: (np.repeat(keys, 3).astype(np.uint32), np.full(len(keys), 3))
    for first in range(0, 6000, 20):
        keys = np.arange(max(first - 10, 0), first + 20, dtype=np.uint64)
        found, sizes = store.lookup(keys, lambda new: ids_of(keys[new]))
        assert found.tolist() == np.repeat(keys, 3).tolist() and set(sizes) == {3}
        copies.add(id(store.ids))
    assert len(copies) < 60  # of 300 additions
