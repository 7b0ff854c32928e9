"""The queries of the corpus operators: one opN_<name> for each operator N.

They run over whole tables. None has oracle SQL: DuckDB has neither XXH64 nor
the tokenizers, and the others are models or iterations; ``tests/llm`` holds
each against a brute-force version instead.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_trie, decontamination, html_extract, language_id, line_dedup, pii, simhash, token_counts, token_store, topk
from .common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe_trie.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_decontamination,
        op3_html_extraction,
        op4_simhash_near_dedup,
        op5_bpe_encode_decode,
        op6_language_id,
        op7_token_counts,
        op8_pii,
        op9_exact_top_k,
        op10_token_files,
    )
}

ORACLE_SQL: dict[str, str] = {}
