"""Message sources, all with the same columns: ``ord``, ``ingest_ts`` and ``value``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schema
from tessera.functions import messages as m

MESSAGE = "ord BIGINT, ingest_ts TIMESTAMP, value STRING"


def kafka_messages(
    spark: SparkSession, servers: str, topic: str,
    max_offsets_per_trigger: int = 10_000_000, **options: str,
) -> DataFrame:
    """A topic from its earliest offset; the query's checkpoint keeps the place.

    ``ord`` orders messages by ``(timestamp, partition, offset)``, across all partitions: 41 bits of
    milliseconds, 10 of the partition and 12 of the offset. It is unique unless a partition of
    up to 1,024 takes more than 4,096 messages in one millisecond, and does not change when the
    topic grows.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        .options(**options)
        .load()
        .select(
            arrival(F.col("timestamp"), F.col("partition"), F.col("offset")).alias("ord"),
            F.col("timestamp").alias("ingest_ts"),
            F.col("value").cast("string").alias("value"),
        )
    )


def arrival(timestamp: Column, partition: Column, offset: Column) -> Column:
    """One integer in the order of ``(timestamp, partition, offset)``."""
    at = F.shiftleft(F.unix_millis(timestamp), 22)
    within = F.pmod(partition, F.lit(1024)).cast("long") * 4096 + F.pmod(offset, F.lit(4096))
    return at.bitwiseOR(within)


def file_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int = 1000, **options: str
) -> DataFrame:
    """A folder of Parquet files with the message columns, as a stream."""
    return (
        spark.readStream.schema(MESSAGE)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .options(**options)
        .parquet(path)
    )


def decode(messages: DataFrame) -> DataFrame:
    """Messages with their type, fingerprint and known fields.

    ``present`` lists the keys of a message, as a present null is not an absent field.
    ``reason`` tells why a message cannot be stored; it is null for all others.
    """
    doc = F.col("doc")
    fields = {schema.column(f): m.field(doc, f) for f in schema.all_fields()}
    keyless = F.coalesce(
        *[
            F.when(F.col("fragment_type") == t, F.col(schema.column(k)).isNull())
            for t, k in schema.FRAGMENT_KEY.items()
        ],
        F.lit(False),
    )
    return (
        messages.select("*", F.inline(m.parsed(F.col("value"))))
        .withColumns(
            {
                "fragment_type": F.when(doc.isNotNull(), m.fragment_type(F.col("keys"))),
                "fingerprint": m.fingerprint(doc),
                **fields,
            }
        )
        .drop("doc", "keys")
        .withColumn(
            "reason",
            F.when(F.col("fragment_type").isNull(), "not a JSON object").when(keyless, "no key"),
        )
    )


def storable(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNull()).drop("reason")


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNotNull()).select("ord", "ingest_ts", "value", "reason")
