"""The scalar functions as SQL functions, so that plain SQL can use them.

Each is a SQL expression that Catalyst inlines; no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tessera.functions.text import BLANKS, TITLES

_CASED = r"\\p{IsLowercase}\\p{IsUppercase}\\p{Lt}"

_FUNCTIONS = {
    "clean_name": (
        "c STRING",
        "STRING",
        "array_join(transform(regexp_extract_all(btrim(regexp_replace(regexp_replace(lower(c),"
        rf" '(?U)\\b({'|'.join(TITLES)})\\b', ''), '[().]', ''), '{BLANKS}'),"
        f" '([{_CASED}]+|[^{_CASED}]+)', 1), x -> initcap(x)), '')",
    ),
    "clean_phone": ("c STRING", "STRING", "regexp_replace(c, '[^+0-9]', '')"),
    "clean_address": ("c STRING", "STRING", "replace(c, ',', '')"),
    "first_sex": ("c ARRAY<STRING>", "STRING", "get(c, 0)"),
    "address_match": (
        "a STRING, b STRING",
        "BOOLEAN",
        "coalesce(a <> '' AND b <> ''"
        " AND replace(lower(a), ' ', '') = replace(lower(b), ' ', ''), false)",
    ),
    "names_in_fullname": (
        "n STRING, l STRING, f STRING",
        "BOOLEAN",
        "coalesce(n <> '' AND l <> '' AND f <> ''"
        f" AND contains(lower(f), btrim(lower(n), '{BLANKS}'))"
        f" AND contains(lower(f), btrim(lower(l), '{BLANKS}')), false)",
    ),
    "message_fingerprint": ("value STRING", "STRING", "sha2(to_json(try_parse_json(value)), 256)"),
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions for this session and return their names."""
    for name, (args, result, body) in _FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {result} RETURN {body}"
        )
    return list(_FUNCTIONS)
