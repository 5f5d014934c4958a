"""The pipeline against a composition by hand, and the registered queries of this folder."""

import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from tidegate.llm import merge_dropout, queries
from tidegate.llm.common import tokenizer_path
from tests_llm_inputs import words
from tools.compare import compare, oracle_connection


def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def test_stages(shipped, sf_dir):
    docs = shipped.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "source_mixture", "piece_ids"]

    good = corpus_pipeline.quality_rules(shipped, docs, sf_dir)
    scores = {r.doc_id: r.predicted for r in queries.op1_quality_rules(shipped, sf_dir).collect()}
    assert good.columns == columns
    assert sorted(r.doc_id for r in good.collect()) == sorted(i for i, p in scores.items() if p == 1)

    one = corpus_pipeline.near_duplicates(shipped, good, sf_dir)
    left = {r.doc_id: shingle_set(r.text) for r in one.collect()}
    assert one.columns == columns
    near = lambda a, b: bool(a) and 100 * len(a & b) >= 80 * len(a | b)
    ids = sorted(left)
    assert not any(near(left[a], left[b]) for a in ids for b in ids if a < b)
    for r in good.collect():
        if r.doc_id not in left:  # every document that goes has a link to another that was there
            assert any(near(shingle_set(r.text), shingle_set(o.text)) for o in good.collect() if o.doc_id != r.doc_id)

    mixed = corpus_pipeline.source_mixture(shipped, one, sf_dir)
    assert mixed.columns == columns and {r.doc_id for r in mixed.collect()} == set(left)

    ids = corpus_pipeline.piece_ids(shipped, mixed, sf_dir).collect()
    assert len(ids) == mixed.count() and all(r.lossless for r in ids)
    codec = merge_dropout.Codec(tokenizer_path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(codec.decode(np.array(r.ids, np.int64)) == texts[r.doc_id] for r in ids)
    whole = corpus_pipeline.run(shipped, sf_dir).collect()
    assert sorted((r.doc_id, r.ids_crc32) for r in whole) == sorted((r.doc_id, r.ids_crc32) for r in ids)


def test_stages_take_odd_tables(odd_docs, no_docs, sf_dir, shipped):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[1:]:
            out = stage(shipped, docs, sf_dir)
            assert name == "piece_ids" or out.columns == docs.columns
            assert (out.count() > 0) == (docs is odd_docs)


@pytest.mark.parametrize("name, table, key", [
    ("op1_quality_rules", "documents", "doc_id"), ("op2_token_ids", "documents", "doc_id"), ("op3_host_runs", "pages", "page_id"),
    ("op4_fingerprints", "documents", "doc_id"), ("op8_merge_dropout", "documents", "doc_id"), ("op10_pair_model", "documents", "doc_id")])
def test_queries_return_every_row(shipped, sf_dir, name, table, key):
    want = pq.read_table(f"{sf_dir}/{table}.parquet", columns=[key])[key].to_pylist()
    assert sorted(r[key] for r in queries.QUERIES[name](shipped, sf_dir).select(key).collect()) == sorted(want)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(shipped, sf_dir, name):
    df = queries.QUERIES[name](shipped, sf_dir)
    ok, message = compare(df, df.collect(), oracle_connection(sf_dir), queries.ORACLES[name])
    assert ok, message


def test_mixing_query_reads_every_document(shipped, sf_dir):
    want = set(pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id"])["doc_id"].to_pylist())
    assert {r.doc_id for r in queries.op5_temperature_mixing(shipped, sf_dir).collect()} == want
