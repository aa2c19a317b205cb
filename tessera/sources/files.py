"""JSON and CSV files of merged people, and JSON files of incomplete persons."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.resolve import flatten
from tessera.sources import arrays


def write_json(df: DataFrame, path: str) -> None:
    """One object per line; a null field is an absent key."""
    df.write.mode("overwrite").json(path)


def filled_columns(df: DataFrame) -> list[str]:
    """The columns that have a value somewhere, sorted; one row of flags reaches the driver."""
    flags = df.agg(*[F.max(F.col(f"`{c}`").isNotNull()).alias(c) for c in df.columns]).first()
    return sorted(c for c in df.columns if flags[c])


def write_csv(people: DataFrame, path: str) -> list[str]:
    """Flat people with a header; columns without any value are left out. Returns the header."""
    flat = flatten(people)
    header = filled_columns(flat)
    (
        flat.select(*[f"`{c}`" for c in header]).write.mode("overwrite")
        .option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return header


def read_csv(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    ddl = ", ".join(f"`{c}` STRING" for c in header)
    return (
        spark.read.schema(ddl).option("header", True).option("escape", '"')
        .option("multiLine", True).csv(path)
    )


def read_records(spark: SparkSession, path: str, ddl: str, array: bool = False) -> DataFrame:
    """Records by a given schema. ``array`` is for files that are one JSON array each."""
    return arrays.read_array(spark, path, ddl) if array else spark.read.schema(ddl).json(path)


def write_json_arrays(df: DataFrame, path: str) -> None:
    """One array per file, one file per partition; a null field is an absent key."""

    def framed(batches):
        before = "["
        for batch in batches:
            values = [before + x if i == 0 else "," + x for i, x in enumerate(batch.column(0).to_pylist())]
            if values:
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], names=["value"])
                before = ","
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if before == "[" else "]"])], names=["value"])

    lines = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))
    lines.mapInArrow(framed, "value string").write.mode("overwrite").text(path)
