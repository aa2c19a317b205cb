"""The read side: facets, and persons by city and job without personal identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import prefix_filter, truthy

# The columns of an answer, in order.
PERSON_VIEW = [
    "sex", "professional_id", "company_name", "company_address", "company_phone_number",
    "company_email", "job_title", "address", "city", "bank_id", "iban", "salary",
    "network_id", "ip_address",
]


def facet(df: DataFrame, column: str) -> DataFrame:
    """The distinct non-empty values, sorted."""
    return df.select(column).where(truthy(F.col(column))).distinct().orderBy(column)


def embedded(tables: dict[str, DataFrame], city: str = "all", job: str = "all") -> DataFrame:
    """Each person with its professional, location, bank and network row, where it has one.

    The filters on city and job are applied to their small tables before any join, and the joins that
    they make selective come first, so that only wanted persons meet bank and network rows.
    """
    work = tables["professional_data"].withColumnRenamed("passport_fk", "passport")
    places = tables["locations"].withColumnRenamed("location_id", "location_id_fk")
    by_job, by_city = (x.lower() not in ("all", "") for x in (job, city))
    if by_job:
        work = work.where(prefix_filter(F.col("job_title"), job))
    if by_city:
        places = places.where(prefix_filter(F.col("city"), city))
    return (
        tables["persons"]
        .join(places, "location_id_fk", "inner" if by_city else "left")
        .join(work, "passport", "inner" if by_job else "left")
        .join(tables["bank_data"].withColumnRenamed("passport_fk", "passport"), "passport", "left")
        .join(
            tables["network_data"].drop("location_id_fk").withColumnRenamed("passport_fk", "passport"),
            "passport", "left",
        )
    )


def persons_by(tables: dict[str, DataFrame], city: str = "all", job: str = "all") -> DataFrame:
    """Persons whose city and job begin with the given texts; ``all`` lets every person pass."""
    return embedded(tables, city, job).select(*PERSON_VIEW)


def _pruned(c: Column, kind: T.DataType) -> Column:
    """A struct without its empty parts; null if nothing is left. Other types as they are."""
    if not isinstance(kind, T.StructType):
        return c
    parts = [_pruned(c.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
    return F.when(F.coalesce(*[F.when(p.isNotNull(), True) for p in parts], F.lit(False)), F.struct(*parts))


def pruned_json(df: DataFrame, alias: str = "json") -> DataFrame:
    """Each row as JSON without null keys, and without objects that have nothing else."""
    parts = [_pruned(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*parts)).alias(alias))
