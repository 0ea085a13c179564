"""A training corpus from raw documents: quality, language, near copies, repeated passages, packed sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import fit_packing, language_mixture, quality_bands, signature_join, suffix_dedup
from slotwise.llm.frames import stored

#: Near copies in the corpus: distinct five-word shingles, similarity of 80 hundredths.
SHINGLE_WORDS = 5
SIMILARITY = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the counted rules or the compression bands go."""
    return quality_bands.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go, and those of which no language holds half."""
    return language_mixture.keep_known(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return signature_join.one_of_each(docs, SHINGLE_WORDS, SIMILARITY)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of passages go, the first stays; ``n_chars`` follows the text."""
    out = suffix_dedup.without_repeats(docs, keep="first")
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    return fit_packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality),
    ("language ID", language),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("best-fit packing", packing),
]

#: Compression, mixtures and packing are not expressible in SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
