"""The data model: fragment fields, keys, and the warehouse tables."""

from __future__ import annotations

# The fields of each fragment, as spelled in the JSON messages.
FRAGMENT_FIELDS = {
    "personal": ["name", "last_name", "sex", "telfnumber", "passport", "email"],
    "location": ["fullname", "city", "address"],
    "professional": [
        "fullname", "company", "company address", "company_telfnumber", "company_email", "job",
    ],
    "bank": ["passport", "IBAN", "salary"],
    "net": ["address", "IPv4"],
}

# The field that identifies a document of each raw collection.
FRAGMENT_KEY = {
    "personal": "passport",
    "location": "fullname",
    "professional": "fullname",
    "bank": "passport",
    "net": "IPv4",
}

UNKNOWN = "unknown"

# The fields two records may share, in order of preference.
IDENTIFYING_KEYS = [
    "passport", "email", "fullname", "telfnumber", "name", "last_name", "address",
]

# Which fields go under which prefix in a flat person row.
FLAT_GROUPS = {
    "personal_": ["name", "last_name", "sex", "telfnumber", "passport", "email"],
    "location_": ["fullname", "address", "city", "IPv4"],
    "professional_": [
        "fullname", "company", "company address", "company_telfnumber", "company_email", "job",
    ],
    "bank_": ["passport", "IBAN", "salary"],
}

# VARCHAR lengths of the warehouse tables.
MAX_LENGTH = {
    "locations": {"address": 255, "city": 100},
    "persons": {
        "passport": 20, "first_name": 100, "last_name": 100, "sex": 10,
        "phone_number": 20, "email": 100,
    },
    "bank_data": {"passport_fk": 20, "iban": 34, "salary": 50},
    "network_data": {"passport_fk": 20},
    "professional_data": {
        "passport_fk": 20, "company_name": 100, "company_address": 255,
        "company_phone_number": 20, "company_email": 100, "job_title": 100,
    },
}

# Columns of the warehouse tables, in order.
WAREHOUSE = {
    "locations": "location_id BIGINT, address STRING, city STRING",
    "persons": "passport STRING, first_name STRING, last_name STRING, sex STRING,"
               " phone_number STRING, email STRING, location_id_fk BIGINT",
    "bank_data": "bank_id BIGINT, passport_fk STRING, iban STRING, salary STRING",
    "network_data": "network_id BIGINT, passport_fk STRING, location_id_fk BIGINT,"
                    " ip_address STRING",
    "professional_data": "professional_id BIGINT, passport_fk STRING, company_name STRING,"
                         " company_address STRING, company_phone_number STRING,"
                         " company_email STRING, job_title STRING",
}

# The column by which a row of each warehouse table is replaced.
WAREHOUSE_KEY = {
    "locations": ["location_id"], "persons": ["passport"], "bank_data": ["passport_fk"],
    "network_data": ["passport_fk"], "professional_data": ["passport_fk"],
}

# How long a message blocks its repeats.
DEDUP_SECONDS = 86_400


def column(field: str) -> str:
    """The column that holds a JSON field; only ``company address`` is spelled otherwise."""
    return field.replace(" ", "_")


def all_fields() -> list[str]:
    """Every known field once, in the order of the fragments."""
    return list(dict.fromkeys(f for fields in FRAGMENT_FIELDS.values() for f in fields))


FIELD_OF = {column(f): f for f in all_fields()}
