"""A corpus pipeline: reject poor documents, keep one of each near-duplicate group, mix sources, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next one's docs. All but the last return the columns of documents; the mixing stage returns a
document once for every time it is to be read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegate.llm import merge_dropout, metric_join, mixing, quality
from tidegate.llm.common import ship, stage, table, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject."""
    ship(spark)
    return quality.keep_good(docs, quality.learn(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return metric_join.keep_one(docs)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture reads them; every document at least once."""
    ship(spark)
    return mixing.mix(docs).select("document.*")


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every reading of a document, with checks that they decode to the text."""
    ship(spark)
    return merge_dropout.encode_documents(merge_dropout.readings(docs), tokenizer_path("piece_bpe_32k.model"), reading="reading")


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("source_mixture", source_mixture),
          ("piece_ids", piece_ids)]

#: Rule fitting, near-duplicate classes and piece merging have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
