"""The recurring batch jobs: load the warehouse from the raw store, analyse what is incomplete."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import scratch
from tessera.functions.cleaning import clean
from tessera.plans import fuse, names, resolve, warehouse
from tessera.sources import audit, buckets, collected, files, observations, snapshots

_INCOMPLETE = ", ".join(f"{c} {'BIGINT' if c == 'ord' else 'STRING'}" for c in [*fuse.FUSED, "missing"])


def load(spark: SparkSession, store: str, root: str) -> int:
    """Fold new batches into the collections, fuse these, upsert the complete persons, and keep the others and the
    refused rows next to the new warehouse version. Returns the version."""
    collected.fold(spark, store)
    parts = {t: clean(df) for t, df in collected.collections(spark, store).items()}
    located = first_locations(spark, f"{root}/names", parts["personal"], parts["location"])
    persons = scratch.materialise(fuse.all_persons(**parts, located=located), "all-persons")
    result = warehouse.load_warehouse(
        fuse.complete(persons), snapshots.read_tables(spark, root), stored=True
    )

    def beside(version: int) -> None:
        files.write_json(fuse.incomplete(persons), f"{root}/incomplete/version={version}")
        result.rejected.write.mode("overwrite").parquet(f"{root}/rejected/version={version}")

    began = time.time()
    version = snapshots.upsert_tables(result.changes, root, beside)
    seconds = {"warehouse insert seconds": time.time() - began}
    observations.write_durations(spark, seconds, f"{root}/metrics", f"durations-{version}")
    _log_load(spark, root, version)
    return version


def first_locations(spark: SparkSession, root: str, personal: DataFrame, location: DataFrame) -> DataFrame:
    """As ``fuse.first_locations``, with an index kept in ``root``: names and full names that loads before have seen cost a
    lookup. Locations may get a lower ``ord`` from load to load, and none goes."""
    version = buckets.latest(spark, root)
    version = 0 if version is None else version + 1
    names.advance(fuse.name_pairs(personal), fuse.name_texts(location), root, version, "location_ord")
    return names.firsts(spark, root, "location_ord")


def _log_load(spark: SparkSession, root: str, version: int) -> None:
    """One log entry per table, for the rows it has, and per reason, for the rows refused."""
    tables = snapshots.read_tables(spark, root)
    counts = None
    for name, df in tables.items():
        step = df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit("INFO").alias("level"), F.lit(name).alias("step"), "n"
        )
        counts = step if counts is None else counts.unionByName(step)
    refused = (
        spark.read.parquet(f"{root}/rejected/version={version}")
        .groupBy(F.concat_ws(": ", "target", "violated").alias("step"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit("ERROR").alias("level"), "step", "n")
    )
    log = counts.unionByName(refused).withColumn("at", F.current_timestamp())
    message = F.format_string("version %d: %d rows, %s", F.lit(version), "n", "step")
    entries = audit.entries(log, "at", F.col("level"), F.lit("load"), message)
    audit.append(entries, f"{root}/log", f"load-{version}")
    seen = log.select("at", F.concat_ws(" ", "level", "step").alias("metric"), F.col("n").cast("double").alias("value"))
    observations.write(seen.withColumnRenamed("at", "ts"), f"{root}/metrics", f"load-{version}")


@dataclass(frozen=True)
class Analysis:
    """Incomplete persons that stored persons match, and clusters among themselves."""

    matches: DataFrame
    clusters: DataFrame


# The report of an analysis, per warehouse version.
REPORT = {"matches": "matches", "clusters": "clusters"}


def write_analysis(spark: SparkSession, root: str) -> int | None:
    """Analyse the last load and keep the report beside it; a repeated run replaces its own. Returns the
    version, or None before the first load."""
    version = snapshots.latest_version(spark, root)
    if version is None:
        return None
    found = analyse(spark, root)
    for name in REPORT:
        getattr(found, name).write.mode("overwrite").parquet(f"{root}/analysis/version={version}/{REPORT[name]}")
    return version


def read_incomplete(spark: SparkSession, root: str) -> DataFrame:
    version = snapshots.latest_version(spark, root)
    return files.read_records(spark, f"{root}/incomplete/version={version}", _INCOMPLETE)


def analyse(spark: SparkSession, root: str) -> Analysis:
    """Compare the incomplete persons of the last load with the stored ones and each other."""
    incomplete = read_incomplete(spark, root)
    persons = snapshots.read_tables(spark, root)["persons"]
    found = resolve.cluster_report(resolve.clusters(incomplete, "ord"))
    return Analysis(
        matches=resolve.any_key_matches(incomplete, "ord", persons, "passport"),
        clusters=scratch.materialise(found, "clusters"),
    )
