"""The numbered queries with their production parameters, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.byte_bpe import bpe_digests
from cohortloom.llm.common import read
from cohortloom.llm.exact_dedup import EXACT_DEDUP_SQL, exact_dedup
from cohortloom.llm.filter_audit import FILTER_AUDIT_SQL, filter_audit
from cohortloom.llm.html_extract import extract_pages
from cohortloom.llm.importance_resampling import importance_resample, resampling_sql
from cohortloom.llm.language_id import language_id
from cohortloom.llm.license_scan import license_sql, scan_licenses
from cohortloom.llm.media import media_table
from cohortloom.llm.near_dedup import near_dedup
from cohortloom.llm.ngram_lm import ngram_scores
from cohortloom.llm.packing import pack_documents
from cohortloom.llm.token_counts import token_counts
from cohortloom.llm.token_store import stored_digests

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORD_VOCABULARY = 49_408
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_table(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", F.lower(F.hex("phash")).alias("feature")
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), WORD_TOKENIZER)


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_digests(read(spark, sf_dir, "documents"), WORD_TOKENIZER, WORD_VOCABULARY, end_id=2)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(read(spark, sf_dir, "documents")).drop("has_letters")


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read(spark, sf_dir, "pages"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents")).drop("row_uid")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


def op10_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_scores(read(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"), WORD_TOKENIZER, limit=2048)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_media, op2_packing, op3_token_store, op4_language_id, op5_html_extract, op6_exact_dedup, op7_near_dedup, op8_byte_bpe, op9_license_scan, op10_ngram_lm, op11_filter_audit, op12_token_counts, op13_importance_resampling)
}
ORACLES: dict[str, str] = {"op6_exact_dedup": EXACT_DEDUP_SQL, "op9_license_scan": license_sql(), "op11_filter_audit": FILTER_AUDIT_SQL, "op13_importance_resampling": resampling_sql()}
