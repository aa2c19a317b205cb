"""What the running jobs observe: rows ``(ts, metric, value)``, in a folder per batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OBSERVATION = "ts TIMESTAMP, metric STRING, value DOUBLE"


def counted(rows: DataFrame, ts: str, metric: Column) -> DataFrame:
    """How many rows there are per metric, at the time of the last."""
    return rows.groupBy(metric.alias("metric")).agg(
        F.max(ts).alias("ts"), F.count(F.lit(1)).cast("double").alias("value")
    ).select("ts", "metric", "value")


def write(rows: DataFrame, path: str, batch: str) -> None:
    """Keep the observations of one batch; a retried batch replaces its own."""
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch}")


def write_durations(spark: SparkSession, seconds: dict[str, float], path: str, batch: str) -> None:
    """Keep how long the steps of one batch took, as of now."""
    rows = spark.createDataFrame([(m, float(s)) for m, s in seconds.items()], "metric STRING, value DOUBLE")
    write(rows.select(F.current_timestamp().alias("ts"), "metric", "value"), path, batch)


def durations(spark: SparkSession, path: str) -> DataFrame:
    """The durations among the observations, for means, histograms and sums per step."""
    return read(spark, path).where(F.col("metric").endswith(" seconds"))


def read(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.schema(f"{OBSERVATION}, batch_id STRING").option("basePath", path).parquet(path)
    return stored.drop("batch_id")
