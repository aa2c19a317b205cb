"""The registered queries of the text operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    chat, decontaminate, negatives, pages, pii, quality, resample, sentencepiece, sharding, simhash, substrings, suffixes,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"), length=13)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.array_join("broken", ",").alias("broken"),
    )


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.round_trip(table(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, distance=4)
    return simhash.with_hex(found).select("doc_id", "fingerprint", "component_id")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(table(spark, sf_dir, "documents"), length=400)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assigned(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detected(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.texts(table(spark, sf_dir, "pages"))


def with_marks(conversations: DataFrame) -> DataFrame:
    """``conversations`` and conversation -1, whose texts look like a template's marks."""
    marks = conversations.sparkSession.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(marks)


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(with_marks(table(spark, sf_dir, "conversations")))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mined(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    import corpus_pipeline

    return {
        "pipeline": corpus_pipeline.run,
        "op1_substring_dedup": op1_substring_dedup,
        "op2_quality_rules": op2_quality_rules,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_simhash_near_dedup": op4_simhash_near_dedup,
        "op5_suffix_array_dedup": op5_suffix_array_dedup,
        "op6_sharding": op6_sharding,
        "op7_benchmark_decontamination": op7_benchmark_decontamination,
        "op8_toxicity": op8_toxicity,
        "op9_pii": op9_pii,
        "op10_html_extraction": op10_html_extraction,
        "op11_chat_formatting": op11_chat_formatting,
        "op12_importance_resampling": op12_importance_resampling,
        "op13_hard_negatives": op13_hard_negatives,
    }
