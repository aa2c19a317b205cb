"""The raw store: every accepted message, in one folder per batch and fragment type.

Batches are only ever added, so a batch costs what it brings and a retry replaces its own
folder. The collections are the field-level merge over all batches: ``merged`` takes it at read time,
``tessera.sources.collected`` keeps it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schema
from tessera.operators.merge import merge_fields

FIELDS = [schema.column(f) for f in schema.all_fields()]

STORED = (
    "ord BIGINT, ingest_ts TIMESTAMP, value STRING, fingerprint STRING, present ARRAY<STRING>, "
    + ", ".join(f"{f} STRING" for f in FIELDS)
    + ", batch_id BIGINT, fragment_type STRING"
)


def write_batch(fragments: DataFrame, path: str, batch_id: int) -> None:
    """Store decoded messages as batch ``batch_id``. Rows are dealt by their number, so that a task sorts about as much as
    any other, whatever the mix of types; by type, all rows that one task reads of a type would go to one task."""
    (
        fragments.hint("rebalance", "ord")
        .write.mode("overwrite")
        .partitionBy("fragment_type")
        .parquet(f"{path}/batch_id={batch_id}")
    )


def read_fragments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).option("basePath", path).parquet(path)


def batches(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the batches that are written in full."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    done = [s.getPath().getName() for s in fs.listStatus(folder) if fs.exists(s.getPath().suffix("/_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in done if n.startswith("batch_id="))


def read_batches(spark: SparkSession, path: str, numbers: list[int]) -> DataFrame:
    """The fragments of some batches; the folders of others are not looked at."""
    folders = [f"{path}/batch_id={n}" for n in numbers]
    return spark.read.schema(STORED).option("basePath", path).parquet(*folders)


def merged(fragments: DataFrame, fragment_type: str) -> DataFrame:
    """One collection as of the last batch, one row per key, in order of first arrival."""
    rows = fragments.where(F.col("fragment_type") == fragment_type)
    if fragment_type == schema.UNKNOWN:
        return rows.groupBy("fingerprint").agg(
            F.min("ord").alias("ord"), F.min_by("value", "ord").alias("value")
        )
    fields = {schema.column(f): f for f in schema.FRAGMENT_FIELDS[fragment_type]}
    return merge_fields(
        rows,
        [schema.column(schema.FRAGMENT_KEY[fragment_type])],
        list(fields),
        "ord",
        {c: F.array_contains("present", f) for c, f in fields.items()},
    )


def collections(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The five typed collections, as the fuse plan takes them."""
    fragments = read_fragments(spark, path)
    return {t: merged(fragments, t) for t in schema.FRAGMENT_FIELDS}
