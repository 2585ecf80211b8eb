"""From raw documents to packed training windows: five stages, each an operator of ``emberline.llm``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.llm import contamination, packing, quality, repeats, simhash
from emberline.llm.common import shared_path, table


def recounted(docs: DataFrame) -> DataFrame:
    """With ``n_chars`` as the text now is, where there is such a column."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents of low quality and toxic ones; sources are the hosts and languages the paths."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: three-word shingles, fingerprints within two bits."""
    return simhash.deduplicated(docs, words=3, budget=2)


def distinct_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages of over 50 words, or of 200 bytes and more, that stand in a document with a smaller id."""
    return recounted(repeats.deduplicated(docs, length=50, least_span=200, least_words=51))


def unseen_tests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without spans of test items of five words and more; documents of which these, or a shorter one, are more than half go."""
    return recounted(contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10, max_span=4, max_coverage=0.5))


def packed_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("repeated_passages", distinct_passages),
    ("decontamination", unseen_tests),
    ("packing", packed_windows),
]

ORACLE_SQL = None  # tokens, fingerprints and fitted weights have no SQL; tests/llm compares with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each writes Parquet in the shared folder for the next to read."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(path := shared_path(spark, f"pipeline-{name}"))
        docs = spark.read.parquet(path)
    return docs
