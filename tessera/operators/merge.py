"""Upserts as aggregations: field by field for raw fragments, row by row for the warehouse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.keyed import first_per_key


def merge_fields(
    df: DataFrame, keys: list[str], fields: list[str], order: str, present: dict[str, Column]
) -> DataFrame:
    """One row per key: each field has the latest value among the rows in which it is present.

    A present null overwrites, an absent field keeps. ``order`` is that of the first row,
    ``last_<order>`` that of the last.
    """
    latest = [
        F.max_by(f, F.when(present[f], F.col(order))).alias(f) for f in fields if f not in keys
    ]
    return df.groupBy(*keys).agg(
        F.min(order).alias(order), F.max(order).alias(f"last_{order}"), *latest
    )


def stamp(field: str) -> str:
    """The column that tells by which row a field was set last."""
    return f"{field}__at"


def stamped_fields(
    df: DataFrame, keys: list[str], fields: list[str], order: str, present: dict[str, Column]
) -> DataFrame:
    """As ``merge_fields``, with the order of the row that set each field beside it, so that more rows can be merged in
    later, in any order of arrival."""
    own = [f for f in fields if f not in keys]
    set_by = {f: F.when(present[f], F.col(order)) for f in own}
    return df.groupBy(*keys).agg(
        F.min(order).alias(order), F.max(order).alias(f"last_{order}"),
        *[F.max_by(f, set_by[f]).alias(f) for f in own],
        *[F.max(set_by[f]).alias(stamp(f)) for f in own],
    )


def merge_stamped(df: DataFrame, keys: list[str], fields: list[str], order: str) -> DataFrame:
    """Rows of ``stamped_fields`` of the same keys as one."""
    own = [f for f in fields if f not in keys]
    return df.groupBy(*keys).agg(
        F.min(order).alias(order), F.max(f"last_{order}").alias(f"last_{order}"),
        *[F.max_by(f, stamp(f)).alias(f) for f in own],
        *[F.max(stamp(f)).alias(stamp(f)) for f in own],
    )


def last_rows(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key, nulls included."""
    return first_per_key(df, keys, [F.desc(order)])


def upsert_rows(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``existing`` with the rows of ``new`` in place of those with the same keys.

    ``new`` has each key once. Columns that one side lacks become null.
    """
    kept = existing.join(new.select(*keys), keys, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)
