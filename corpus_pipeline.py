"""The corpus pipeline: every stage works on all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import mixing, quality, simhash, spm, substring
from millrace.llm.common import only
from millrace.llm.queries import PIECES, table
from millrace.session import fresh_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A trained network, an index and a tokenizer are beyond SQL.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network does not reject; it learns from those among them that are labelled."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, the one with the smallest doc_id."""
    return only(docs, simhash.first_of_each(docs))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that repeat."""
    return substring.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The blocks that the mix takes, as documents; a document taken twice is two rows."""
    return mixing.mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids and decoded text of every document, as digests."""
    return spm.encode_documents(docs, public_tokenizers.path(PIECES))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in a row; what a stage returns is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = fresh_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
