"""The cleaning projection over whatever fields a DataFrame has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import text

_CLEANERS = {
    "telfnumber": text.clean_phone,
    "company_telfnumber": text.clean_phone,
    "city": text.clean_address,
    "address": text.clean_address,
    "company_address": text.clean_address,
}


def clean(df: DataFrame) -> DataFrame:
    """Clean the known fields; ``last_name``, ``fullname`` and ``email`` stay as they are."""
    cleaned = {c: _CLEANERS[c](F.col(c)) for c in df.columns if c in _CLEANERS}
    if "sex" in df.columns and isinstance(df.schema["sex"].dataType, T.ArrayType):
        cleaned["sex"] = F.get("sex", F.lit(0)).cast("string")
    if "name" in df.columns:
        # A generator, unlike a projection, is not copied into the expressions, filters and keys that
        # use its result, so each costly step runs once per row.
        df = df.withColumn("name", F.explode(F.array(text.bare_name(F.col("name")))))
        df = df.withColumn("name", F.explode(F.array(text.title_case(F.col("name")))))
    return df.withColumns(cleaned) if cleaned else df
