"""Registered queries of the llm operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapecraft.llm import oracles
from tapecraft.llm.bpe import round_trip
from tapecraft.llm.filter_audit import audit
from tapecraft.llm.hnsw import nearest_neighbours
from tapecraft.llm.language_id import identify_languages
from tapecraft.llm.license_scan import license_scan
from tapecraft.llm.merkle import verified_manifest
from tapecraft.llm.mixing import mix_sources
from tapecraft.llm.ngram_join import near_duplicates
from tapecraft.llm.repetition import repetition_rules
from tapecraft.llm.simhash import fingerprint_report
from tapecraft.llm.token_files import encode_to_files, read_token_files
from tapecraft.llm.url_filters import fetch_days, judge_captures, list_log, validity_intervals
from tapecraft.llm.warc import archive_round_trip
from tapecraft.session import scratch_path


TOKENIZER_FILE = public_tokenizers.path("byte_bpe_50k.json")
RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents"))


def op6_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_captures(fetch_days(pages), validity_intervals(list_log(pages)))


def op2_hnsw_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(spark, _table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op7_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(spark, _table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = encode_to_files(_table(spark, sf_dir, "documents"), scratch_path(spark, "token-files"),
                             TOKENIZER_FILE, end_id=2)
    return read_token_files(spark, shards)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "documents"), RANK_FILE)


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(spark, _table(spark, sf_dir, "documents"), F.col("doc_id") % 50 == 0)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_manifest(spark, _table(spark, sf_dir, "documents"))


LLM_QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_hnsw_shards": op2_hnsw_shards,
    "op3_license_scan": op3_license_scan,
    "op4_mix_sources": op4_mix_sources,
    "op5_language_id": op5_language_id,
    "op6_repetition_rules": op6_repetition_rules,
    "op7_warc_index": op7_warc_index,
    "op8_token_files": op8_token_files,
    "op9_ngram_join": op9_ngram_join,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_simhash": op11_simhash,
    "op12_filter_audit": op12_filter_audit,
    "op13_merkle_manifest": op13_merkle_manifest,
}

LLM_ORACLES = {
    "op1_url_filters": oracles.URL_FILTERS,
    "op3_license_scan": oracles.LICENSE_SCAN,
    "op4_mix_sources": oracles.MIX_SOURCES,
    "op6_repetition_rules": oracles.REPETITION_RULES,
    "op12_filter_audit": oracles.FILTER_AUDIT,
}
