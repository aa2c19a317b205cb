"""Tables written to the cluster's shared folder, to cut lineage durably."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one on a local master only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-"))
    return spark.sparkContext.getCheckpointDir()


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and read it back: lost executors cost a re-read, not a re-run, and the
    planner sees true sizes when it picks join strategies."""
    return stored(df, label, partition_by)[0]


def stored(
    df: DataFrame, label: str, partition_by: list[str] | None = None
) -> tuple[DataFrame, str]:
    """As ``materialise``, with the path, for tables that are dropped before the job ends."""
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    """Remove a table this module wrote."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear(spark: SparkSession) -> None:
    """Remove all tables of this application, once its results are written."""
    drop(spark, _folder(spark))
