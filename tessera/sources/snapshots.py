"""Versioned snapshots of the warehouse: a load reads one version and writes the next, of which only the buckets
with changed rows are new files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera import schema
from tessera.sources import buckets


def latest_version(spark: SparkSession, root: str) -> int | None:
    """The last version that was written in full."""
    return buckets.latest(spark, root)


def read_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the latest version; none before the first load."""
    held = buckets.load(spark, root, latest_version(spark, root)).tables
    return {t: buckets.read(spark, root, held[t]) for t in schema.WAREHOUSE if t in held}


def _next(
    spark: SparkSession, root: str, make: Callable[[dict[str, buckets.Table]], dict[str, buckets.Table]],
    beside: Callable[[int], None] | None,
) -> int:
    last = latest_version(spark, root)
    version = 0 if last is None else last + 1
    tables = make(buckets.load(spark, root, last).tables)
    if beside:
        beside(version)
    buckets.commit(spark, root, version, tables)
    return version


def _put(df: DataFrame, root: str, name: str, held: buckets.Table | None) -> buckets.Table:
    return buckets.update(df, root, name, schema.WAREHOUSE_KEY[name], schema.WAREHOUSE[name], held)


def write_tables(
    tables: dict[str, DataFrame], root: str, beside: Callable[[int], None] | None = None
) -> int:
    """Write the next version, all of it anew; it counts only once all tables are there, and what ``beside`` writes
    for the same version."""
    spark = next(iter(tables.values())).sparkSession
    return _next(spark, root, lambda held: {t: _put(df, root, t, None) for t, df in tables.items()}, beside)


def upsert_tables(
    changes: dict[str, DataFrame], root: str, beside: Callable[[int], None] | None = None
) -> int:
    """Write the next version with these rows put in by key. Rows that are stored already as they are change
    nothing, and buckets without a changed row keep their files."""
    spark = next(iter(changes.values())).sparkSession

    def make(held: dict[str, buckets.Table]) -> dict[str, buckets.Table]:
        made = dict(held)
        for name, df in changes.items():
            made[name] = _put(buckets.differing(df, root, held.get(name)), root, name, held.get(name))
        return made

    return _next(spark, root, make, beside)


def write_jdbc(df: DataFrame, url: str, table: str, key: str, **options: str) -> str:
    """Replace the staging table ``<table>_incoming`` of a database, and return the statement that
    upserts it into ``table``, for the database to run in one transaction: no table with foreign keys is
    emptied. The driver jar is the caller's."""
    staging = f"{table}_incoming"
    df.write.format("jdbc").options(url=url, dbtable=staging, **options).mode("overwrite").save()
    return upsert_statement(df.columns, table, staging, key)


def upsert_statement(columns: list[str], table: str, staging: str, key: str) -> str:
    names = ", ".join(columns)
    changed = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c != key)
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} ON CONFLICT ({key}) DO UPDATE SET {changed}"
