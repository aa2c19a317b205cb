"""A corpus pipeline of five stages over ``documents``.

Each stage works on all rows that its predecessor kept; ``run`` writes each stage's result as
Parquet to the shared folder and reads it back, so that a lost executor costs no earlier stage.
All stages but the last return the columns of ``documents``.

Nulls, empty and repeated rows, empty tables and extra columns are handled as the operators say;
``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import scratch
from tessera.llm import decontaminate, pii, quality, sentencepiece, simhash

SHINGLE_WORDS = 4
DISTANCE = 4


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that break no quality rule."""
    return quality.passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each SimHash component."""
    return simhash.representatives(docs, SHINGLE_WORDS, DISTANCE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a passage of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked by its kind."""
    masked = pii.masked(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids)`` of all documents."""
    return sentencepiece.encoded(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("pii", personal_data),
    ("sentencepiece", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Bit distances, alignments, votes and pieces are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None
