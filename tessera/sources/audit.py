"""The audit log: one JSON line per step and batch, in a folder per batch and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import day_of, second_of

ENTRY = "timestamp STRING, level STRING, source STRING, message STRING, day STRING"


def entries(df: DataFrame, ts: str, level, source, message) -> DataFrame:
    """Shape rows as log entries; ``level``, ``source`` and ``message`` are columns."""
    return df.select(
        second_of(F.col(ts)).alias("timestamp"), level.alias("level"), source.alias("source"),
        message.alias("message"), day_of(F.col(ts)).alias("day"),
    )


def append(log: DataFrame, path: str, batch: str) -> None:
    """Write the entries of one batch to a folder of its own; a retried batch replaces itself."""
    (
        log.hint("rebalance", "day").write.mode("overwrite").partitionBy("day")
        .json(f"{path}/batch_id={batch}")
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.schema(f"{ENTRY}, batch_id STRING").option("basePath", path).json(path)
    return stored.drop("batch_id")
