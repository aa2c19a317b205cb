"""Table constraints as data: each row gets the list of the rules it violates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import schema
from tessera.functions.text import truthy

VIOLATED = "violated"


def with_violations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Add ``violated``: the names of the checks that a row fails, in order."""
    failed = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()])
    return df.withColumn(VIOLATED, F.array_compact(failed))


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.size(VIOLATED) == 0)


def required(columns: list[str]) -> dict[str, Column]:
    return {f"missing {c}": truthy(F.col(c)) for c in columns}


def within_length(table: str) -> dict[str, Column]:
    """Null passes: whether a column may be null is a rule of its own."""
    return {
        f"long {c}": F.col(c).isNull() | (F.length(c) <= n)
        for c, n in schema.MAX_LENGTH[table].items()
    }


def add_violation(df: DataFrame, broken: Column, name: str) -> DataFrame:
    """Append ``name`` to the violations of the rows that were still accepted."""
    clean = F.size(VIOLATED) == 0
    return df.withColumn(
        VIOLATED, F.when(clean & broken, F.array(F.lit(name))).otherwise(F.col(VIOLATED))
    )


def check_unique(
    df: DataFrame, column: str, owner: str, order: str, existing: DataFrame | None
) -> DataFrame:
    """Reject a value that ``existing`` holds for another owner, then all but its first row.

    Rows already rejected hold nothing.
    """
    if existing is not None:
        held = existing.select(F.col(column), F.col(owner).alias("__owner"))
        df = df.join(held, column, "left")
        taken = F.col("__owner").isNotNull() & (F.col("__owner") != F.col(owner))
        df = add_violation(df, taken, f"duplicate {column}").drop("__owner")
    # Joined back by the unique order, never by the value: a hot value gathers nowhere.
    firsts = accepted(df).groupBy(column).agg(F.min(order).alias(order))
    df = df.join(firsts.select(order, F.lit(True).alias("__first")), order, "left")
    later = F.col(column).isNotNull() & F.col("__first").isNull()
    return add_violation(df, later, f"duplicate {column}").drop("__first")


def check_parent(df: DataFrame, column: str, parents: DataFrame, name: str) -> DataFrame:
    """Reject rows whose ``column`` is not among ``parents``, which has each value once."""
    known = parents.select(F.col(parents.columns[0]).alias(column), F.lit(True).alias("__known"))
    df = df.join(known, column, "left")
    return add_violation(df, F.col("__known").isNull(), name).drop("__known")
