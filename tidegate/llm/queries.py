"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from tidegate.llm import chat_tree, fingerprints, host_runs, license_scan, lm, merge_dropout, metric_join, mixing, near_vectors, quality, token_alignment, token_ids, whitening
from tidegate.llm.common import table, tokenizer_path
from tidegate.llm.oracles import ORACLES


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = token_ids.write_token_shards(table(spark, sf_dir, "documents", "doc_id", "text"),
                                          tokenizer_path("byte_bpe_50k.json"))
    return token_ids.read_token_shards(shards)


def op3_host_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_runs.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprints.fingerprint(table(spark, sf_dir, "documents", "doc_id", "text"))
    return prints.withColumns({c: F.base64(c) for c in ("fingerprint", "edited_fingerprint")})


def op5_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("document.doc_id", "source", "pass", "block", "place", F.col("tokens").alias("n_tokens"),
                        F.round("weight", 9).alias("weight"), F.round("exponent", 9).alias("exponent"))


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op7_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    # One more conversation, whose texts hold the template's own control strings.
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)],
                                  "conv_id bigint, turn bigint, role string, text string")
    return chat_tree.read_back(*chat_tree.build(turns.unionByName(extra)))


def op8_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("piece_bpe_32k.model")
    return merge_dropout.read_back(merge_dropout.encode_documents(table(spark, sf_dir, "documents", "doc_id", "text"), path), path)


def op9_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.jaccard_classes(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_pair_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_all(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(table(spark, sf_dir, "documents", "doc_id", "text"),
                                        tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_token_ids, op3_host_runs, op4_fingerprints, op5_temperature_mixing,
                                   op6_near_vectors, op7_chat_tree, op8_merge_dropout, op9_metric_join,
                                   op10_pair_model, op11_embedding_whitening, op12_license_scan,
                                   op13_token_alignment)}
QUERIES["pipeline"] = corpus_pipeline.run
__all__ = ["ORACLES", "QUERIES"]
