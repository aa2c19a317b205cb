"""Whole persons from their fragments: name containment, full name, passport, address.

Inputs are cleaned fragments with a unique ``ord``, the order of arrival. A person meets at
most one fragment of each kind, the first that fits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import address_key, fold, truthy
from tessera.operators.containment import first_containing
from tessera.operators.keyed import first_per_key

FRAGMENTS = ["location", "professional", "bank", "net"]

_PERSON = ["ord", "passport", "name", "last_name", "sex", "telfnumber", "email"]
_PROFESSIONAL = ["company", "company_address", "company_telfnumber", "company_email", "job"]

FUSED = [
    *_PERSON, "fullname", "city", "address", *_PROFESSIONAL, "IBAN", "salary", "IPv4",
]


def name_pairs(personal: DataFrame) -> DataFrame:
    """``(a, b)``: the names that are looked for."""
    return personal.where(truthy(F.col("name")) & truthy(F.col("last_name"))).select(
        fold(F.col("name")).alias("a"), fold(F.col("last_name")).alias("b")
    )


def name_texts(location: DataFrame) -> DataFrame:
    """``(text, location_ord)``: the full names that they are looked for in."""
    return location.select(F.lower("fullname").alias("text"), F.col("ord").alias("location_ord"))


def first_locations(personal: DataFrame, location: DataFrame) -> DataFrame:
    """``(a, b, location_ord)``: the first location whose full name contains both names."""
    return first_containing(name_pairs(personal), name_texts(location), "location_ord")


def sites(location: DataFrame, professional: DataFrame, net: DataFrame, how: str) -> DataFrame:
    """Each location with its professional and net fragment; ``how`` is inner or left."""
    work = first_per_key(professional, ["fullname"], [F.asc("ord")]).select(
        "fullname", *_PROFESSIONAL, F.lit(True).alias("has_professional")
    )
    net = first_per_key(
        net.withColumn("address_key", address_key(F.col("address"))), ["address_key"], [F.asc("ord")]
    ).select(
        "address_key", F.col("address").alias("net_address"), "IPv4", F.lit(True).alias("has_net")
    )
    return (
        location.select(
            F.col("ord").alias("location_ord"), "fullname", "city", "address",
            address_key(F.col("address")).alias("address_key"),
        )
        .join(work, "fullname", how)
        .join(net, "address_key", how)
        .drop("address_key")
    )


def _match(
    personal: DataFrame,
    location: DataFrame,
    professional: DataFrame,
    bank: DataFrame,
    net: DataFrame,
    how: str,
    located: DataFrame | None = None,
) -> DataFrame:
    accounts = first_per_key(bank, ["passport"], [F.asc("ord")]).select(
        "passport", "IBAN", "salary", F.lit(True).alias("has_bank")
    )
    named = truthy(F.col("name")) & truthy(F.col("last_name"))
    people = personal.select(
        *_PERSON,
        F.when(named, fold(F.col("name"))).alias("a"),
        F.when(named, fold(F.col("last_name"))).alias("b"),
    )
    if located is None:
        located = first_locations(personal, location)
    return (
        people.join(located, ["a", "b"], how)
        .join(sites(location, professional, net, how), "location_ord", how)
        .join(accounts, "passport", how)
    )


def fuse_persons(
    personal: DataFrame,
    location: DataFrame,
    professional: DataFrame,
    bank: DataFrame,
    net: DataFrame,
) -> DataFrame:
    """The complete persons. Where fragments disagree, net's spelling of the address wins."""
    whole = _match(personal, location, professional, bank, net, "inner")
    return whole.withColumn("address", F.col("net_address")).select(*FUSED)


def all_persons(
    personal: DataFrame,
    location: DataFrame,
    professional: DataFrame,
    bank: DataFrame,
    net: DataFrame,
    located: DataFrame | None = None,
) -> DataFrame:
    """Every person with what was found and ``missing``, the fragments that were not.

    Without a location, neither professional nor net can be looked up: they are missing too. ``located`` is what
    ``first_locations`` gives, where that is kept from load to load (``names.py``).
    """
    found = _match(personal, location, professional, bank, net, "left", located)
    has = {
        "location": F.col("location_ord").isNotNull(),
        "professional": F.col("has_professional").isNotNull(),
        "bank": F.col("has_bank").isNotNull(),
        "net": F.col("has_net").isNotNull(),
    }
    missing = F.concat_ws(",", *[F.when(~has[f], F.lit(f)) for f in FRAGMENTS])
    address = F.when(has["net"], F.col("net_address")).otherwise(F.col("address"))
    return found.withColumn("address", address).select(*FUSED, missing.alias("missing"))


def complete(persons: DataFrame) -> DataFrame:
    return persons.where(F.col("missing") == "").drop("missing")


def incomplete(persons: DataFrame) -> DataFrame:
    return persons.where(F.col("missing") != "")


def incomplete_persons(**fragments: DataFrame) -> DataFrame:
    """The persons that lack a fragment."""
    return incomplete(all_persons(**fragments))


def completeness_totals(persons: DataFrame) -> DataFrame:
    """One row over ``all_persons``: how many are complete, and how many lack each fragment."""
    lacking = [
        F.count_if(F.array_contains(F.split("missing", ","), f)).alias(f"missing_{f}")
        for f in FRAGMENTS
    ]
    return persons.agg(
        F.count(F.lit(1)).alias("persons"),
        F.count_if(F.col("missing") == "").alias("complete"),
        F.count_if(F.col("missing") != "").alias("incomplete"),
        *lacking,
    )
