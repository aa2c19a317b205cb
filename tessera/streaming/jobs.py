"""Jobs that follow the stream: rolling means, numbered snapshots, recurring analyses."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.functions.cleaning import clean
from tessera.operators.metrics import PANES, SLIDE_SECONDS, WINDOW_SECONDS, panes, windows
from tessera.plans import etl, people
from tessera.plans.resolve import group_records
from tessera.scratch import materialise
from tessera.sources import buckets, files, raw

# The period of the analysis of incomplete persons.
ANALYSIS_PERIOD = "20 seconds"


def rolling_mean_stream(
    stream: DataFrame, ts: str, metric: str, value: str, path: str, checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the panes of each batch in a folder of its number; ``rolling_means`` reads them.

    Panes of several batches add up, so there is no state, no row is too late, and the last windows are
    there as soon as their rows are. A retried batch replaces itself.
    """

    def write(df: DataFrame, batch: int) -> None:
        summed = panes(df, ts, metric, value).withColumnRenamed(metric, "metric")
        summed.write.mode("overwrite").parquet(f"{path}/batch_id={batch}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


_FOLDED = "metric STRING, hour BIGINT, pane BIGINT, total DECIMAL(38,6), observations BIGINT"
_PANES_AN_HOUR = 3600 // SLIDE_SECONDS


def _hours(rows: DataFrame) -> DataFrame:
    return rows.select("metric", F.floor(F.col("pane") / _PANES_AN_HOUR).alias("hour"), "pane", "total", "observations")


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("metric", "hour", "pane").agg(
        F.sum("total").cast("decimal(38,6)").alias("total"), F.sum("observations").alias("observations")
    )


def _base(path: str) -> str:
    """Beside the folder of batches, which holds nothing else."""
    return f"{path.rstrip('/')}-folded"


def fold_panes(spark: SparkSession, path: str) -> int | None:
    """Add the panes of all new batches to a base that is dealt by hour, so that the files of a recent window do not grow
    with the age of the stream. A batch is added once: the version that has it says so. Returns the version."""
    root = _base(path)
    last = buckets.latest(spark, root)
    held = buckets.load(spark, root, last)
    new = buckets.pending(held.note, raw.batches(spark, path))
    if not new:
        return last
    changes = materialise(_sums(_hours(_batches(spark, path, new))), "panes")
    table = buckets.update(
        changes, root, "panes", ["hour"], _FOLDED, held.tables.get("panes"),
        lambda stored, added: _sums(stored.unionByName(added)),
    )
    version = 0 if last is None else last + 1
    buckets.commit(spark, root, version, {"panes": table}, buckets.noted(held.note, new))
    return version


def _batches(spark: SparkSession, path: str, numbers: list[int]) -> DataFrame:
    folders = [f"{path}/batch_id={n}" for n in numbers]
    return spark.read.schema(PANES).option("basePath", path).parquet(*folders)


def rolling_means(
    spark: SparkSession, path: str, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """Mean per metric over the last minute, every ten seconds, over all batches so far; or from a time on, up to
    another or now, for which only the base's files of those hours are read and the batches that are not folded yet."""
    root = _base(path)
    held = buckets.load(spark, root, buckets.latest(spark, root))
    new = buckets.pending(held.note, raw.batches(spark, path))
    rows = _batches(spark, path, new).drop("batch_id") if new else spark.createDataFrame([], PANES).drop("batch_id")
    table = held.tables.get("panes")
    first = None if since is None else int(since.timestamp()) // SLIDE_SECONDS - WINDOW_SECONDS // SLIDE_SECONDS
    if table is not None:
        only = None
        if first is not None:
            last = time.time() if until is None else until.timestamp()
            hours = spark.range(first // _PANES_AN_HOUR, int(last) // 3600 + 1).withColumnRenamed("id", "hour")
            only = buckets.touched(table, hours)
        rows = rows.unionByName(buckets.read(spark, root, table, only).drop("hour"))
    if first is not None:
        rows = rows.where(F.col("pane") >= first)
    found = windows(rows, "metric")
    if until is not None:
        found = found.where(F.col("window_end") <= F.lit(until))
    return found if since is None else found.where(F.col("window_end") >= F.lit(since))


def people_so_far(fragments: DataFrame) -> DataFrame:
    """All stored fragments, cleaned, merged to people by their identifying values."""
    return group_records(clean(fragments), "ord", raw.FIELDS, present="present")


def snapshot_people(fragments: DataFrame, path: str, number: int | str) -> None:
    """Write the people of all these fragments as JSON and CSV; ``number`` is that of the batch, or ``final``."""
    _export(materialise(people_so_far(fragments), "people"), path, number)


def _export(merged: DataFrame, path: str, number: int | str) -> None:
    files.write_json(merged, f"{path}/json/batch={number}")
    files.write_csv(merged, f"{path}/csv/batch={number}")


def snapshots(
    stream: DataFrame, store: str, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """A numbered snapshot of the people after each micro-batch of decoded fragments. The source's
    rate limit (``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger``) sets the batch size.

    The people are kept in ``<path>/state``, so a batch links and merges its own records and the people they touch; only
    the export writes them all."""

    def write(df: DataFrame, batch: int) -> None:
        spark, state = df.sparkSession, f"{path}/state"
        raw.write_batch(df, store, batch)
        new = clean(raw.read_batches(spark, store, [batch]))
        people.advance(new, state, batch, "ord", raw.FIELDS, present="present")
        _export(people.people(spark, state, raw.FIELDS, batch), path, batch)
        buckets.vacuum(spark, state)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def recurring(
    stream: DataFrame, job: Callable[[DataFrame, int], None], checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run ``job`` whenever the period has passed and there is something new."""
    return (
        stream.writeStream.foreachBatch(job)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": ANALYSIS_PERIOD}))
        .start()
    )


def recurring_analysis(
    stream: DataFrame, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Report on the incomplete persons of the last load whenever messages came in the period."""
    return recurring(stream, lambda df, _: etl.write_analysis(df.sparkSession, root), checkpoint, trigger)
