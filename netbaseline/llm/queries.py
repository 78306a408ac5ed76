"""The registered queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (bpe, decontamination, html_text, jaccard_groups, line_dedup, mixing, multi_index, quality, resampling,
               substring_dedup, token_counts, url_reputation, vector_codes)
from .common import read_table
from .oracles import ORACLE_SQL  # noqa: F401  (registered with the queries)

#: The vocabulary file; a path that every executor can read.
TOKENIZER = os.environ.get("NETBASELINE_TOKENIZER") or public_tokenizers.path("byte_bpe_50k.json")
MAX_TOKENS = 1024


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    both = docs.select("doc_id", bpe.bpe_round_trip(F.col("text"), TOKENIZER).alias("b")).select("doc_id", "b.*")
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups.jaccard_components(read_table(spark, sf_dir, "documents"), width=3, percent=90)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(read_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return lines.select("doc_id", "text", F.col("l_lines").alias("n_lines"), F.col("l_removed").alias("n_removed"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.vector_links(read_table(spark, sf_dir, "embeddings"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(read_table(spark, sf_dir, "documents"), TOKENIZER)
    return counts.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages"))


def op9_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_reputation.judge_urls(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents")).drop("copies")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode_vectors(read_table(spark, sf_dir, "embeddings"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontamination.benchmark_hits(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_html_text": op8_html_text,
    "op9_url_reputation": op9_url_reputation,
    "op10_mixing": op10_mixing,
    "op11_vector_codes": op11_vector_codes,
    "op12_resampling": op12_resampling,
    "op13_decontamination": op13_decontamination,
}
