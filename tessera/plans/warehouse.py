"""Load of whole persons into the five warehouse tables, with rejected rows kept aside.

Order of the checks: a location that is refused leaves a null id; a person that is refused
takes its bank, network and professional rows along, unless its passport is already stored.
A value that the existing tables hold for another passport stays with its holder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import schema, scratch
from tessera.functions.text import is_ipv4, truthy
from tessera.operators import constraints as check
from tessera.operators.keyed import numbered, spread_group
from tessera.operators.merge import upsert_rows

REJECTED = ["target", "ord", "passport", "violated"]


@dataclass(frozen=True)
class Load:
    """The warehouse tables after a load, the rows it put into them, and the rows it refused."""

    tables: dict[str, DataFrame]
    changes: dict[str, DataFrame]
    rejected: DataFrame


def person_rows(fused: DataFrame) -> DataFrame:
    return fused.select(
        "ord", "passport", F.col("name").alias("first_name"), "last_name", "sex",
        F.col("telfnumber").alias("phone_number"), "email", "location_id_fk",
    )


def bank_rows(fused: DataFrame) -> DataFrame:
    return fused.select(
        "ord", F.col("passport").alias("passport_fk"), F.col("IBAN").alias("iban"), "salary"
    )


def network_rows(fused: DataFrame) -> DataFrame:
    return fused.select(
        "ord", F.col("passport").alias("passport_fk"), "location_id_fk",
        F.col("IPv4").alias("ip_address"),
    )


def professional_rows(fused: DataFrame) -> DataFrame:
    return fused.select(
        "ord", F.col("passport").alias("passport_fk"), F.col("company").alias("company_name"),
        "company_address", F.col("company_telfnumber").alias("company_phone_number"),
        "company_email", F.col("job").alias("job_title"),
    )


def _max_id(table: DataFrame | None, column: str) -> int:
    """One value, for the next serial id."""
    return (table.agg(F.max(column)).first()[0] or 0) if table is not None else 0


def locations_of(fused: DataFrame) -> DataFrame:
    """The location of each person that names one, with its violations."""
    named = fused.where(truthy(F.col("address")) & truthy(F.col("city")))
    return check.with_violations(
        named.select("ord", "passport", "address", "city"), check.within_length("locations")
    )


def new_locations(fused: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """A row, with the next ids, for each location that is not known yet."""
    seen = spread_group(
        check.accepted(locations_of(fused)), ["address", "city"], F.min("ord").alias("ord")
    )
    if existing is not None:
        seen = seen.join(existing, ["address", "city"], "left_anti")
    created = numbered(seen, "ord", "location_id", _max_id(existing, "location_id"))
    return created.select("location_id", "address", "city")


def load_locations(fused: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Get or create: the known locations and the new ones."""
    created = new_locations(fused, existing)
    return created if existing is None else existing.unionByName(created)


def with_location_id(fused: DataFrame, locations: DataFrame) -> DataFrame:
    """``location_id_fk`` by address and city; null where there is none."""
    ids = locations.withColumnRenamed("location_id", "location_id_fk")
    return fused.join(ids, ["address", "city"], "left")


def check_persons(fused: DataFrame, existing: DataFrame | None) -> DataFrame:
    rows = check.with_violations(
        person_rows(fused),
        check.required(["passport", "first_name", "last_name", "email"])
        | check.within_length("persons"),
    )
    return check.check_unique(rows, "email", "passport", "ord", existing)


def _check_child(
    rows: DataFrame,
    table: str,
    required: str,
    unique: str | None,
    persons: DataFrame,
    existing: DataFrame | None,
) -> DataFrame:
    rules = check.required(["passport_fk", required]) | check.within_length(table)
    if table == "network_data":
        rules["invalid ip_address"] = is_ipv4(F.col("ip_address"))
    checked = check.with_violations(rows, rules)
    checked = check.check_parent(checked, "passport_fk", persons, "unknown person")
    if unique is None:
        return checked
    return check.check_unique(checked, unique, "passport_fk", "ord", existing)


def _with_ids(rows: DataFrame, existing: DataFrame | None, id_column: str) -> DataFrame:
    """Rows to replace by ``passport_fk``: a stored one keeps its id, a new one gets the next."""
    if existing is None:
        return numbered(rows, "ord", id_column)
    rows = rows.join(existing.select("passport_fk", id_column), "passport_fk", "left")
    stored = rows.where(F.col(id_column).isNotNull())
    fresh = numbered(
        rows.where(F.col(id_column).isNull()).drop(id_column),
        "ord", id_column, _max_id(existing, id_column),
    )
    return stored.unionByName(fresh).drop("ord")


def _shape(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[c.split()[0] for c in schema.WAREHOUSE[table].split(", ")])


def _rejects(checked: DataFrame, target: str, passport: str) -> DataFrame:
    return checked.where(F.size("violated") > 0).select(
        F.lit(target).alias("target"), "ord", F.col(passport).alias("passport"),
        F.array_join("violated", "; ").alias("violated"),
    )


_CHILDREN = [
    ("bank_data", bank_rows, "iban", "iban", "bank_id"),
    ("network_data", network_rows, "ip_address", "ip_address", "network_id"),
    ("professional_data", professional_rows, "company_name", None, "professional_id"),
]


def load_warehouse(
    fused: DataFrame, existing: dict[str, DataFrame] | None = None, stored: bool = False
) -> Load:
    """Upsert ``fused``, which has each passport once, into ``existing`` or empty tables.

    The fused rows and the checked ones feed both tables and refusals, so they are written once; ``stored``
    tells that ``fused`` comes from files already.
    """
    existing = existing or {}
    if not stored:
        fused = scratch.materialise(fused, "fused")
    created = scratch.materialise(new_locations(fused, existing.get("locations")), "locations")
    locations = existing["locations"].unionByName(created) if "locations" in existing else created
    fused = with_location_id(fused, locations)
    old = existing.get("persons")
    persons = scratch.materialise(check_persons(fused, old), "persons")
    accepted = _shape(check.accepted(persons), "persons")
    known = accepted if old is None else upsert_rows(old, accepted, ["passport"])
    tables = {"locations": locations, "persons": known}
    changes = {"locations": created, "persons": accepted}
    rejected = [
        _rejects(locations_of(fused), "locations", "passport"),
        _rejects(persons, "persons", "passport"),
    ]
    for table, rows_of, required, unique, id_column in _CHILDREN:
        held = existing.get(table)
        checked = scratch.materialise(
            _check_child(rows_of(fused), table, required, unique, known.select("passport"), held),
            f"checked-{table}",
        )
        changes[table] = _shape(_with_ids(check.accepted(checked).drop("violated"), held, id_column), table)
        tables[table] = changes[table] if held is None else upsert_rows(held, changes[table], ["passport_fk"])
        rejected.append(_rejects(checked, table, "passport_fk"))
    whole = rejected[0]
    for part in rejected[1:]:
        whole = whole.unionByName(part)
    return Load(tables, changes, whole)
