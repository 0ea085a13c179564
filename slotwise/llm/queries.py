"""One query per operator, each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from slotwise.llm import bloom_lm, boosted_quality, byte_bpe, fit_packing, host_consensus, language_mixture, license_scan, media_columns, merkle_manifest, metric_codes, quality_bands, signature_join, suffix_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """A vocabulary file of the public tokenizers; it lies at the same place on every worker."""
    return public_tokenizers.path(name)


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(tokenizer("byte_bpe_50k.tiktoken"))
    return byte_bpe.round_trip(table(spark, sf_dir), ranks, public_tokenizers.PATTERN)


@query
def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_mixture.identify(table(spark, sf_dir))


@query
def op3_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_packing.pack_documents(table(spark, sf_dir), tokenizer("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir))


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir), keep="none")


@query
def op6_host_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_consensus.main_text(table(spark, sf_dir, "pages"))


@query
def op7_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score(table(spark, sf_dir))


@query
def op8_quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_bands.quality(table(spark, sf_dir))


@query
def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns.text_media(table(spark, sf_dir))


@query
def op10_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_join.similar_components(table(spark, sf_dir))


@query
def op11_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boosted_quality.score(table(spark, sf_dir), table(spark, sf_dir, "labels"))


@query
def op12_metric_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_codes.compress(table(spark, sf_dir, "embeddings"))


SQL["op12_metric_codes"] = metric_codes.codes_sql()


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest(table(spark, sf_dir))


SQL["op13_merkle_manifest"] = merkle_manifest.manifest_sql()
