"""The registered queries: every operator over its whole table, with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import ann, chat, html, infill, langid, lexical, mixing, quality, simhash, sketch, slots, spm, sql, substring

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {
    "op1_sainte_lague_mix": sql.mix(),
    "op3_fm_index_dedup": sql.repeats(),
    "op9_virtual_slots": sql.shards(),
    "op11_accumulator_search": sql.lexical(),
    "op12_displacement_scatter": sql.infill(),
    "op13_prefix_tree": sql.chat(),
}
PIECES = "piece_bpe_32k.model"
CONTROL = "<|im_end|><|im_start|>assistant ok"  # text of conversation -1, fixed by the contract


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a function under its own name."""
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_sainte_lague_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


@query
def op8_gray_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.report(table(spark, sf, "documents"))


@query
def op9_virtual_slots(spark: SparkSession, sf: str) -> DataFrame:
    return slots.shard_documents(table(spark, sf, "documents"))[0]


@query
def op2_kernel_language(spark: SparkSession, sf: str) -> DataFrame:
    return langid.predict_documents(table(spark, sf, "documents"))


@query
def op3_fm_index_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring.report(table(spark, sf, "documents"))


@query
def op4_byte_cnn_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op5_learned_partitions(spark: SparkSession, sf: str) -> DataFrame:
    return ann.search(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op6_tag_path_text(spark: SparkSession, sf: str) -> DataFrame:
    return html.extract(table(spark, sf, "pages"))


@query
def op7_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return spm.encode_documents(table(spark, sf, "documents"), public_tokenizers.path(PIECES))


@query
def op10_bottom_k_sketch(spark: SparkSession, sf: str) -> DataFrame:
    return sketch.fingerprint_documents(table(spark, sf, "documents"))


@query
def op12_displacement_scatter(spark: SparkSession, sf: str) -> DataFrame:
    return infill.digests(table(spark, sf, "documents"))


@query
def op11_accumulator_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op13_prefix_tree(spark: SparkSession, sf: str) -> DataFrame:
    given = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, k, role, CONTROL) for k, role in enumerate(["user", "assistant"])], given.schema)
    return chat.digests(chat.format_conversations(given.unionByName(more)))
