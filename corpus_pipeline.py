"""Corpus pipeline over ``documents``: a list of stages, each written as Parquet before the next.

Nulls, empty and very long texts, repeated rows and ties have in each stage the result that its operator's module
defines: a null or empty text has no words (the quality rules reject it), a null id is a document like any other, and
an empty table goes through all stages as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from placewise.llm import decontaminate, mixing, quality, simhash, token_files
from placewise.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates by op3's shingles and radius, that of the smallest doc_id; null ids come last."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that the tokens of sources, languages and topics meet their target weights; one of a value
    that must be raised may come more than once. Equal rows are drawn alike."""
    return mixing.sampled(docs, repeat=True)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, and a row for each document as read back from them."""
    return token_files.tokens_round_trip(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("source mixing", mixture),
    ("token output", token_output),
]

#: Compression, tokenization and file layout are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
