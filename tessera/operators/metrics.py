"""Step metrics over a table of observations ``(ts, metric, value)`` or of steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.messages import byte_size

# Upper bounds of the cumulative histogram buckets; the last one is unbounded.
BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]

WINDOW_SECONDS = 60
SLIDE_SECONDS = 10


def exact(c: Column) -> Column:
    """As a decimal, so that sums do not depend on the order of the rows."""
    return c.cast("decimal(28,6)")


def step_counters(df: DataFrame, step: str, error: Column) -> DataFrame:
    return df.groupBy(step).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(error).alias("errors")
    )


def observed(df: DataFrame, name: str, error: Column) -> DataFrame:
    """Count rows and errors while ``df`` runs, without a pass of its own."""
    return df.observe(name, F.count(F.lit(1)).alias("total"), F.count_if(error).alias("errors"))


def mean_message_size(df: DataFrame, value: str) -> DataFrame:
    size = byte_size(F.col(value))
    return df.agg(
        F.count(value).alias("messages"),
        F.sum(size).alias("total_bytes"),
        F.avg(size).alias("mean_bytes"),
    )


def histogram(df: DataFrame, metric: str, value: str, bounds: list[float] = BUCKETS) -> DataFrame:
    """Cumulative buckets per metric in one pass: ``(metric, le, bucket)``."""
    labels = [str(b) for b in bounds] + ["+Inf"]
    counts = [F.count_if(F.col(value) <= b) for b in bounds] + [F.count(value)]
    buckets = F.array(
        *[F.struct(F.lit(le).alias("le"), n.alias("bucket")) for le, n in zip(labels, counts)]
    )
    return (
        df.groupBy(metric).agg(buckets.alias("buckets"))
        .select(metric, F.explode("buckets").alias("b"))
        .select(metric, "b.le", "b.bucket")
    )


def summary(df: DataFrame, metric: str, value: str) -> DataFrame:
    return df.groupBy(metric).agg(
        F.count(value).alias("observations"), F.sum(exact(F.col(value))).alias("total")
    )


def last_status(df: DataFrame, ok: Column, ts: str, order: str, *by: str) -> DataFrame:
    """1 or 0 for the outcome of the last row."""
    status = ok.cast("int")
    return df.groupBy(*by).agg(F.max_by(status, F.struct(ts, order)).alias("status"))


# The columns of stored panes.
PANES = "metric STRING, pane BIGINT, total DECIMAL(38,6), observations BIGINT, batch_id BIGINT"


def panes(df: DataFrame, ts: str, metric: str, value: str, slide_seconds: int = SLIDE_SECONDS) -> DataFrame:
    """Sums per metric and slide."""
    pane = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / slide_seconds).alias("pane")
    return df.groupBy(metric, pane).agg(
        F.sum(exact(F.col(value))).alias("total"), F.count(value).alias("observations")
    )


def windows(
    summed: DataFrame, metric: str, window_seconds: int = WINDOW_SECONDS, slide_seconds: int = SLIDE_SECONDS
) -> DataFrame:
    """Means over windows of whole panes; panes of one metric and slide add up."""
    count = window_seconds // slide_seconds
    if count * slide_seconds != window_seconds:
        raise ValueError("the window must be a whole number of slides")
    return (
        summed.select(
            metric, "total", "observations",
            F.explode(F.sequence(F.col("pane") + 1, F.col("pane") + count)).alias("end"),
        )
        .groupBy(metric, F.timestamp_seconds(F.col("end") * slide_seconds).alias("window_end"))
        .agg(F.sum("total").alias("total"), F.sum("observations").alias("observations"))
        .withColumn("mean", F.col("total").cast("double") / F.col("observations"))
    )


def rolling_mean(
    df: DataFrame,
    ts: str,
    metric: str,
    value: str,
    window_seconds: int = WINDOW_SECONDS,
    slide_seconds: int = SLIDE_SECONDS,
) -> DataFrame:
    """Mean per metric over windows that end every ``slide_seconds``.

    Rows are first summed into panes of one slide; only panes are copied to the windows.
    """
    return windows(panes(df, ts, metric, value, slide_seconds), metric, window_seconds, slide_seconds)
