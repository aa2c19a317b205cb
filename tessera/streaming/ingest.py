"""Messages to raw collections, continuously: decode, dedup, route, store, count.

``ingest_all`` is the whole of it in one query that reads the source once. ``ingest``, ``quarantine`` and
``audit_batches`` are its parts as queries of their own, each with its own place in the source.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera import scratch
from tessera.sources import audit, buckets as versions, observations, raw
from tessera.sources.messages import decode, quarantined, storable
from tessera.streaming.dedup import BUCKETS, ttl_dedup_stream, ttl_outcomes_stream

#: What became of a message, as it is kept until all outputs of its batch are written.
_ARRIVED = "ord BIGINT, ingest_ts TIMESTAMP, value STRING, fragment_type STRING, outcome STRING"


def accepted_messages(messages: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The messages that can be stored and are no repeats, decoded.

    Only the text and its fingerprint pass the stateful step; decoding them again afterwards is
    cheaper than to carry every field through it.
    """
    narrow = storable(decode(messages)).select("ord", "ingest_ts", "value", "fingerprint")
    fresh = ttl_dedup_stream(narrow, "fingerprint", "ingest_ts", "ord", buckets=buckets)
    return storable(decode(fresh.drop("fingerprint")))


def ingest(
    messages: DataFrame, store: str, checkpoint: str, trigger: dict | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Store each message that is not a repeat. A failed batch is retried as a whole: it writes
    to the folder of its own number, so nothing is lost and nothing is stored twice."""

    def write(df: DataFrame, batch: int) -> None:
        raw.write_batch(df, f"{store}/fragments", batch)
        stored = raw.read_fragments(df.sparkSession, f"{store}/fragments").where(F.col("batch_id") == batch)
        observations.write(
            observations.counted(stored, "ingest_ts", F.concat(F.lit("stored "), "fragment_type")),
            f"{store}/metrics", f"stored-{batch}",
        )

    return (
        accepted_messages(messages, buckets)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint}/ingest")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def quarantine(
    messages: DataFrame, store: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the messages that cannot be stored, with the reason, and let the others pass."""
    return (
        quarantined(decode(messages))
        .writeStream.format("parquet")
        .option("path", f"{store}/quarantine")
        .option("checkpointLocation", f"{checkpoint}/quarantine")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def audit_batches(
    messages: DataFrame, store: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """One log entry per batch, step and outcome, with the number of messages, and the same numbers as
    metrics. Received less stored less refused messages of a type are the repeats."""

    def write(df: DataFrame, batch: int) -> None:
        decoded = decode(df)
        step = F.coalesce("reason", F.concat(F.lit("received "), "fragment_type"))
        observations.write(
            observations.counted(decoded, "ingest_ts", step), f"{store}/metrics", f"received-{batch}"
        )
        counted = (
            decoded.groupBy(F.coalesce("fragment_type", F.lit("none")).alias("step"), "reason")
            .agg(F.count(F.lit(1)).alias("n"), F.max("ingest_ts").alias("at"))
        )
        message = F.format_string("batch %d: %d %s messages", F.lit(batch), "n", "step")
        audit.append(
            audit.entries(
                counted, "at",
                F.when(F.col("reason").isNull(), "INFO").otherwise("ERROR"),
                F.lit("ingest"),
                F.concat_ws(", ", message, "reason"),
            ),
            f"{store}/log", f"ingest-{batch}",
        )

    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint}/audit")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def outcomes(messages: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Every message with its type and its outcome: ``stored``, ``repeat``, or why it is refused. Repeats come
    without their text."""
    decoded = decode(messages)
    reason = F.coalesce("reason", F.when(F.col("ingest_ts").isNull(), "no time"))
    narrow = decoded.select("ord", "ingest_ts", "value", "fragment_type", "fingerprint", reason.alias("outcome"))
    found = ttl_outcomes_stream(
        narrow, "fingerprint", "ingest_ts", "ord", "outcome", ["value"], buckets=buckets
    )
    return found.drop("fingerprint")


def _write_outputs(spark: SparkSession, arrived: DataFrame, store: str, batch: int) -> dict[str, float]:
    """All outputs of one batch, each in a folder of the batch; returns the seconds of the insert."""
    began = time.time()
    stored = arrived.where(F.col("outcome") == "stored").select("ord", "ingest_ts", "value")
    raw.write_batch(storable(decode(stored)), f"{store}/fragments", batch)
    inserted = time.time() - began
    refused = ~F.col("outcome").isin("stored", "repeat")
    arrived.where(refused).select("ord", "ingest_ts", "value", F.col("outcome").alias("reason")).write.mode(
        "overwrite"
    ).parquet(f"{store}/quarantine/batch_id={batch}")
    kind = F.coalesce("fragment_type", F.lit("none"))
    counted = scratch.materialise(
        arrived.groupBy(kind.alias("kind"), "outcome").agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.max("ingest_ts"), F.current_timestamp()).alias("at")
        ),
        "outcomes",
    )
    bad = ~F.col("outcome").isin("stored", "repeat")
    received = counted.where(~bad).groupBy(F.concat(F.lit("received "), "kind").alias("metric")).agg(
        F.max("at").alias("ts"), F.sum("n").cast("double").alias("value")
    )
    kept = counted.where(F.col("outcome") != "repeat").groupBy(
        F.when(bad, F.col("outcome")).otherwise(F.concat(F.lit("stored "), "kind")).alias("metric")
    ).agg(F.max("at").alias("ts"), F.sum("n").cast("double").alias("value"))
    observations.write(
        received.unionByName(kept).select("ts", "metric", "value"), f"{store}/metrics", f"ingest-{batch}"
    )
    message = F.format_string("batch %d: %d %s messages, %s", F.lit(batch), "n", "kind", "outcome")
    audit.append(
        audit.entries(counted, "at", F.when(bad, "ERROR").otherwise("INFO"), F.lit("ingest"), message),
        f"{store}/log", f"ingest-{batch}",
    )
    return {"raw insert seconds": inserted}


def ingest_all(
    messages: DataFrame, store: str, checkpoint: str, trigger: dict | None = None, buckets: int = BUCKETS
) -> StreamingQuery:
    """Fragments, quarantine, audit log, counts and durations from one pass over the source.

    A batch is first written as it arrived, with the outcome of each message; all outputs come from that. Each output
    has a folder per batch, and the batch counts once its commit record is there. A batch that was cut off between two
    outputs is done again as a whole and replaces what it left, so nothing is there in part or twice. Stored, repeated
    and refused messages add up to those received.
    """

    def write(df: DataFrame, batch: int) -> None:
        spark, began = df.sparkSession, time.time()
        path = f"{store}/arrived/batch_id={batch}"
        df.write.mode("overwrite").parquet(path)
        seconds = {"send seconds": time.time() - began}
        seconds |= _write_outputs(spark, spark.read.schema(_ARRIVED).parquet(path), store, batch)
        observations.write_durations(spark, seconds, f"{store}/metrics", f"durations-{batch}")
        versions.commit(spark, f"{store}/commits", batch, {}, seconds)
        scratch.drop(spark, path)

    return (
        outcomes(messages, buckets)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint}/ingest-all")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def committed(spark: SparkSession, store: str) -> list[int]:
    """The batches of ``ingest_all`` whose outputs are all there."""
    return versions.versions(spark, f"{store}/commits")


def read_quarantine(spark: SparkSession, store: str) -> DataFrame:
    """The refused messages of all committed batches, with the reason."""
    ddl = "ord BIGINT, ingest_ts TIMESTAMP, value STRING, reason STRING"
    paths = [f"{store}/quarantine/batch_id={n}" for n in committed(spark, store)]
    return spark.read.schema(ddl).parquet(*paths) if paths else spark.createDataFrame([], ddl)
