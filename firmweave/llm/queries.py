"""One query per operator over its whole table, with production parameters, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmweave.llm import language_id, lexical_search, license_scan, line_dedup, merkle, mixing, near_dedup, packing, quality_rules, substring_dedup, token_files, topk_search, url_filter
from firmweave.storage import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.score_quality(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


@query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), width=4, percent=80)


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = scratch_dir(spark, "token-files")
    token_files.write_tokens(documents(spark, sf_dir), uri, tokenizer())
    return token_files.read_tokens(spark, uri, digests=True)


@query
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.word_counts_taken(documents(spark, sf_dir))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer(), keep_ids=False)


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.removed_lines(documents(spark, sf_dir)).drop("row")


@query
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk_search.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20, scale=64)


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(documents(spark, sf_dir)).drop("body")


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("doc_id", F.col("doc_id").cast("long"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    docs = docs.select("doc_id", "text", "lang", held_out.alias("held_out"))
    out = language_id.identify(docs, docs.where("not held_out"), among=~F.col("held_out"))
    return out.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir))


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=20)


@query
def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir), seen={"text": merkle.tampered_text()})


ORACLE_SQL["op11_lexical_search"] = lexical_search.SQL
ORACLE_SQL["op13_merkle_manifest"] = merkle.SQL
ORACLE_SQL["op12_url_filter"] = url_filter.SQL
ORACLE_SQL["op6_exact_top_k"] = topk_search.SQL
ORACLE_SQL["op7_substring_dedup"] = substring_dedup.SQL
ORACLE_SQL["op9_license_scan"] = license_scan.SQL
