"""Records as (key, value) rows, the form in which any-key matches are equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, record_id: str, keys: list[str], *carried: str) -> DataFrame:
    """One row per record and non-empty key: ``(record_id, *carried, pos, key, value)``.

    ``pos`` is the place of the key in ``keys``; keys the DataFrame lacks yield nothing.
    """
    present = [(pos, k) for pos, k in enumerate(keys) if k in df.columns]
    if not present:
        raise ValueError(f"none of {keys} is a column of the records")
    rows = F.array(
        *[
            F.struct(
                F.lit(pos).alias("pos"), F.lit(k).alias("key"), F.col(k).cast("string").alias("value")
            )
            for pos, k in present
        ]
    )
    return (
        df.select(record_id, *carried, F.explode(rows).alias("m"))
        .select(record_id, *carried, "m.pos", "m.key", "m.value")
        .where(F.col("value") != "")
    )


def link_columns(link_mode: str) -> list[str]:
    """``key_value``: equal values link under the same key; ``value``: under any key."""
    if link_mode not in ("key_value", "value"):
        raise ValueError(f"unknown link mode: {link_mode}")
    return ["key", "value"] if link_mode == "key_value" else ["value"]
