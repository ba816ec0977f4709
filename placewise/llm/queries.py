"""Registered queries of the operators over ``documents`` and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewise.llm import (alignment, decontaminate, licenses, line_dedup, lm_scoring, mixing, phrases, quality, secret_scan, simhash,
                           suffix_dedup, token_counts, token_files)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query
def op9_quality_bands(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(documents(spark, folder), row=["doc_id"])
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", F.round("ratio", 6).alias("ratio"), "n_chunks", "n_bad_chunks")


@query
def op3_simhash_covering(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, folder))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"),
                                        row=["doc_id"])
    return found.select("row.doc_id", "n_words", "n_hit", "n_items",
                        decontaminate.items_digest(F.col("items")).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"), "longest", "item_id", "item_word", "doc_word")


@query
def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.tokens_round_trip(documents(spark, folder))


@query
def op4_raked_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, folder), row=["doc_id"])
    return mixed.select("row.doc_id", "source", "lang", "topic", "tokens", F.round("weight", 3).alias("weight"),
                        F.round("probability", 6).alias("probability"), "kept", "copies")


ORACLE["op4_raked_mix"] = mixing.mix_sql()


@query
def op1_license_templates(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_licenses(documents(spark, folder), row=["doc_id"])
    return found.select("row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                        F.round("score", 6).alias("score"), F.size("matches").cast("long").alias("n_matches"))


@query
def op6_secret_forest(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(documents(spark, folder))
    return found.withColumn("score", F.round("score", 6))


@query
def op2_suffix_intervals(spark: SparkSession, folder: str) -> DataFrame:
    done = suffix_dedup.remove_repeats(documents(spark, folder), row=["doc_id"])
    return done.select("row.doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query
def op10_attention_score(spark: SparkSession, folder: str) -> DataFrame:
    scored = lm_scoring.score(documents(spark, folder), row=["doc_id"])
    return scored.select("row.doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op8_line_edit_join(spark: SparkSession, folder: str) -> DataFrame:
    done = line_dedup.dedupe_lines(documents(spark, folder), row=["doc_id"])
    return done.select("row.doc_id", "n_lines", "n_equal", "n_near", "n_kept", "n_links",
                       F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE["op8_line_edit_join"] = line_dedup.dedupe_sql()


@query
def op11_pair_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    found = alignment.align(documents(spark, folder), row=["doc_id"])
    return found.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(documents(spark, folder), row=["doc_id"])
    return counted.select("row.doc_id", "n_bytes", "n_tokens", "over_limit", "n_direct")


@query
def op13_phrase_cycles(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(documents(spark, folder))


ORACLE["op13_phrase_cycles"] = phrases.collocations_sql()
