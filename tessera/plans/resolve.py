"""Which records may be the same person: lookups, links, clusters and merged records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import scratch
from tessera.functions.text import truthy
from tessera.operators.components import components, value_links
from tessera.operators.keyed import first_per_key, spread_group
from tessera.operators.melt import link_columns, melt
from tessera.schema import FIELD_OF, FLAT_GROUPS, IDENTIFYING_KEYS, column


def any_key_matches(
    records: DataFrame, record_id: str, others: DataFrame, other_id: str,
    keys: list[str] = IDENTIFYING_KEYS,
) -> DataFrame:
    """Each record's values that occur under the same key among ``others``.

    One row per record and matching key, with the number of others that have the value and
    the least of their ids. With the same call the other way round, the two results joined
    on ``(key, value)`` are the whole match relation; it is kept in this factored form because a
    value shared by n records and m others stands for n × m pairs.
    """
    theirs = spread_group(
        melt(others, other_id, keys), ["key", "value"],
        F.count(F.lit(1)).alias("matches"), F.min(other_id).alias("first_match"),
    )
    return melt(records, record_id, keys).join(theirs, ["key", "value"]).select(
        record_id, "key", "value", "matches", "first_match"
    )


def any_key_links(
    records: DataFrame, record_id: str, keys: list[str] = IDENTIFYING_KEYS,
    link_mode: str = "key_value",
) -> DataFrame:
    """Links from each record to the first one with an equal value, as ``(child, parent)``.

    They connect exactly the records that all matching pairs would connect.
    """
    return value_links(melt(records, record_id, keys), record_id, link_columns(link_mode))


def clusters(
    records: DataFrame, record_id: str, keys: list[str] = IDENTIFYING_KEYS,
    link_mode: str = "key_value",
) -> DataFrame:
    """``(record_id, component)`` for every record."""
    return components(records, record_id, any_key_links(records, record_id, keys, link_mode))


def cluster_report(clustered: DataFrame) -> DataFrame:
    """Clusters of more than one record, with their size."""
    sizes = spread_group(clustered, ["component"], F.count(F.lit(1)).alias("records"))
    return clustered.join(sizes.where(F.col("records") > 1), "component")


def group_records(
    records: DataFrame,
    record_id: str,
    fields: list[str],
    keys: list[str] = IDENTIFYING_KEYS,
    link_mode: str = "key_value",
    present: str | None = None,
) -> DataFrame:
    """One merged record per cluster: for each field the latest value, by ``record_id``.

    ``present`` names an array column of the message fields a record has; a field in it may be
    null and then overwrites. Without it, a null field counts as absent.
    """
    records = scratch.materialise(records, "records")  # read by the links, the clusters and the merge
    grouped = records.join(clusters(records, record_id, keys, link_mode), record_id)

    def has(f: str):
        return F.array_contains(present, FIELD_OF.get(f, f)) if present else F.col(f).isNotNull()

    return grouped.groupBy("component").agg(
        F.count(F.lit(1)).alias("records"),
        *[F.max_by(f, F.when(has(f), F.col(record_id))).alias(f) for f in fields],
    )


def passport_by_name_or_address(records: DataFrame, record_id: str) -> DataFrame:
    """For each record, the passport of the first other one with its full name or address.

    Of each value only the first two records with a passport are kept: one of them is
    not the record that asks.
    """
    shared = ["fullname", "address"]
    known = melt(records.where(truthy(F.col("passport"))), record_id, shared, "passport")
    found = F.struct(record_id, "passport")
    firsts = spread_group(
        first_per_key(known, ["key", "value"], [F.asc(record_id)], n=2), ["key", "value"],
        F.min(found).alias("one"), F.max(found).alias("two"),
    )
    other = F.when(F.col(f"one.{record_id}") != F.col(record_id), F.col("one")).when(
        F.col(f"two.{record_id}") != F.col(record_id), F.col("two")
    )
    hits = (
        melt(records, record_id, shared)
        .join(firsts, ["key", "value"])
        .groupBy(record_id)
        .agg(F.min(other).alias("found"))
    )
    return records.select(record_id).join(hits, record_id, "left").select(
        record_id, F.col("found.passport").alias("passport")
    )


def location_id_by_address_city(records: DataFrame, record_id: str, locations: DataFrame) -> DataFrame:
    """The location id of each record; null where address or city is empty or unknown."""
    named = records.select(
        record_id, F.nullif("address", F.lit("")).alias("address"),
        F.nullif("city", F.lit("")).alias("city"),
    )
    return named.join(locations, ["address", "city"], "left").select(record_id, "location_id")


def person_by_priority(
    records: DataFrame, record_id: str, people: DataFrame, person_id: str,
    keys: list[str] = IDENTIFYING_KEYS,
) -> DataFrame:
    """For each record, the person found by the first of its keys whose value is known.

    A value is known under any key, and points to the person that registered it last.
    """
    index = spread_group(
        melt(people, person_id, keys), ["value"], F.max(person_id).alias("person")
    )
    return (
        melt(records, record_id, keys)
        .join(index, "value")
        .groupBy(record_id)
        .agg(
            F.min_by("person", "pos").alias("person"), F.min_by("key", "pos").alias("found_by")
        )
    )


def flatten(df: DataFrame) -> DataFrame:
    """The known fields under the prefix of their category; others are dropped."""
    return df.select(
        *[
            F.col(column(f)).alias(prefix + f)
            for prefix, fields in FLAT_GROUPS.items()
            for f in fields
            if column(f) in df.columns
        ]
    )
