"""Fragments derived from the test tables, in SQL that Spark and DuckDB both run.

Every customer yields all five fragments. Some fragments lack the value they are joined by
(a null full name, passport or address), which is how persons come to be incomplete.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,"
                " c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
              " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,"
              " value DOUBLE, props STRING",
}



def _given(key: str) -> str:
    return (
        f"CASE {key} % 4 WHEN 0 THEN 'ANA' WHEN 1 THEN 'Jean-Paul'"
        " WHEN 2 THEN 'o''neil' ELSE 'José' END"
    )


def _passport(key: str) -> str:
    return f"'P' || lpad(CAST({key} AS STRING), 9, '0')"


_GIVEN = _given("c_custkey")
_PASSPORT = _passport("c_custkey")
_LAST = "'Ln' || CAST(c_custkey AS STRING)"
_FULL = f"{_GIVEN} || ' ' || {_LAST}"
_ADDRESS = "CAST(c_custkey AS STRING) || ' Calle, ' || c_mktsegment"
_EMAIL_OWNER = "CASE WHEN c_custkey % 100 = 99 THEN c_custkey - 1 ELSE c_custkey END"

VIEWS = {
    "fx_personal": f"""
        SELECT c_custkey AS ord, {_PASSPORT} AS passport,
          CASE c_custkey % 5 WHEN 0 THEN 'Mr. ' WHEN 1 THEN 'Dr ' WHEN 2 THEN 'sra. ' ELSE '' END
            || {_GIVEN} AS name,
          {_LAST} AS last_name,
          CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
          '+34 (6) ' || CAST(c_custkey AS STRING) || '-00x1' AS telfnumber,
          'u' || CAST({_EMAIL_OWNER} AS STRING) || '@mail.example' AS email
        FROM customer""",
    "fx_location": f"""
        SELECT c_custkey AS ord,
          CASE WHEN c_custkey % 13 = 12 THEN NULL ELSE {_FULL} END AS fullname,
          n_name AS city, {_ADDRESS} AS address
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "fx_professional": f"""
        SELECT c_custkey AS ord,
          CASE WHEN c_custkey % 17 = 16 THEN NULL ELSE {_FULL} END AS fullname,
          s_name AS company, 'Av, ' || s_name AS company_address,
          '+1.' || CAST(s_suppkey AS STRING) || ' ext 9' AS company_telfnumber,
          lower(s_name) || '@corp.example' AS company_email, c_mktsegment AS job
        FROM (SELECT *, c_custkey % (SELECT max(s_suppkey) + 1 FROM supplier) AS employer FROM customer) c
        JOIN supplier ON s_suppkey = employer""",
    "fx_bank": f"""
        SELECT c_custkey AS ord,
          CASE WHEN c_custkey % 7 = 6 THEN NULL ELSE {_PASSPORT} END AS passport,
          'IB' || lpad(CAST(c_custkey AS STRING), 20, '0') AS IBAN,
          CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS STRING) || '$' AS salary
        FROM customer""",
    "fx_net": f"""
        SELECT c_custkey AS ord,
          CASE WHEN c_custkey % 11 = 10 THEN NULL ELSE upper({_ADDRESS}) || ' ' END AS address,
          '10.' || CAST(c_custkey % 200 AS STRING) || '.'
            || CAST(CAST(floor(c_custkey / 200) AS BIGINT) % 250 AS STRING) || '.7' AS IPv4
        FROM customer""",
}


def _json(**fields: str) -> str:
    """A JSON object as a concatenation; the values are SQL texts, null where they are."""
    parts = [
        f"""'"{name.replace('__', ' ')}": ' || coalesce('"' || ({sql}) || '"', 'null')"""
        for name, sql in fields.items()
    ]
    return "'{' || " + " || ', ' || ".join(parts) + " || '}'"


_FIRST_TS = "CAST('1990-01-01 00:00:00' AS TIMESTAMP)"


def _messages_of(view: str, place: int, value: str) -> str:
    return (
        f"SELECT ord * 5 + {place} AS ord, {_FIRST_TS} AS ingest_ts, {value} AS value"
        f" FROM ({VIEWS[view]}) f"
    )


# Messages as they come in: the five fragments of each customer, updates from orders (a present
# null, a bank change, a phone change with two orders of keys), and from events objects of
# no known type, with blanks in front or cut off.
VIEWS["fx_messages"] = " UNION ALL ".join(
    [
        _messages_of(
            "fx_personal", 0,
            "replace("
            + _json(name="name", last_name="last_name", sex="sex", telfnumber="telfnumber",
                    passport="passport", email="email")
            + """, '"sex": "F"', '"sex": ["F"]')""",
        ),
        _messages_of("fx_location", 1, _json(fullname="fullname", city="city", address="address")),
        _messages_of(
            "fx_professional", 2,
            _json(fullname="fullname", company="company", company__address="company_address",
                  company_telfnumber="company_telfnumber", company_email="company_email", job="job"),
        ),
        _messages_of("fx_bank", 3, _json(passport="passport", IBAN="IBAN", salary="salary")),
        _messages_of("fx_net", 4, _json(address="address", IPv4="IPv4")),
        f"""SELECT 1000000000 + o_orderkey AS ord, CAST(o_orderdate AS TIMESTAMP) AS ingest_ts,
          CASE o_orderstatus
            WHEN 'P' THEN {_json(passport=_passport('o_custkey'), name=_given('o_custkey'),
                                 sex='CAST(NULL AS STRING)')}
            WHEN 'F' THEN {_json(passport=_passport('o_custkey'),
                                 IBAN="'IB' || lpad(CAST(o_custkey AS STRING), 20, '0')",
                                 salary="CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) || '$'")}
            ELSE CASE o_custkey % 2
              WHEN 0 THEN {_json(telfnumber="'6' || CAST(o_custkey % 7 AS STRING)",
                                 name=_given('o_custkey'), passport=_passport('o_custkey'))}
              ELSE {_json(passport=_passport('o_custkey'), name=_given('o_custkey'),
                          telfnumber="'6' || CAST(o_custkey % 7 AS STRING)")}
              END
          END AS value
        FROM orders""",
        """SELECT 2000000000 + event_id AS ord, CAST(ts AS TIMESTAMP) AS ingest_ts,
          CASE event_type WHEN 'error' THEN substr(props, 1, 4) WHEN 'signup' THEN '  ' || props
            ELSE props END AS value
        FROM events""",
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, whole; the schema is given, so no job runs to find it."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def spark_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    used = [t for t in TABLES if re.search(rf"\b{t}\b", sql)]
    for t in used:
        table(spark, sf_dir, t).createOrReplaceTempView(f"source_{t}")
    sources = ", ".join(f"{t} AS (SELECT * FROM source_{t})" for t in used)
    return spark.sql(f"WITH {sources} {sql}")
