"""Column expressions over JSON messages: decode, fingerprint, route, size."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera import schema


def parsed(value: Column) -> Column:
    """An array with one struct ``(doc, present, keys)``, to be inlined as a row: the message as a
    variant, its keys, and its keys in lower case; all null unless it is a JSON object.

    Inlining, unlike a projection, is never merged into the expressions that use its result, so a
    message is parsed once however often its parts are used.
    """
    whole = F.transform(
        F.array(F.try_parse_json(value)),
        lambda doc: F.struct(
            doc.alias("doc"),
            F.map_keys(F.try_variant_get(doc, "$", "map<string,variant>")).alias("present"),
        ),
    )
    return F.transform(
        whole,
        lambda m: F.struct(
            F.when(m["present"].isNotNull(), m["doc"]).alias("doc"),
            m["present"].alias("present"),
            F.transform(m["present"], F.lower).alias("keys"),
        ),
    )


def fragment_type(keys: Column) -> Column:
    """Which raw collection a message with these lower-cased keys belongs to; the first rule that
    fits wins."""

    def has(name: str) -> Column:
        return F.array_contains(keys, name)

    return (
        F.when(has("passport") & has("name"), "personal")
        .when(has("fullname") & has("city"), "location")
        .when(has("company") | has("job"), "professional")
        .when(has("iban"), "bank")
        .when(has("ipv4"), "net")
        .otherwise(schema.UNKNOWN)
    )


def fingerprint(doc: Column) -> Column:
    """Equal for messages with the same content, whatever the order of keys and the spacing."""
    return F.sha2(F.to_json(doc), 256)


def _at(field: str) -> str:
    return f"$['{field}']"


def field(doc: Column, name: str) -> Column:
    """A field as text. A list, as in ``sex``, gives its first element."""
    text = F.try_variant_get(doc, _at(name), "string")
    if name != "sex":
        return text
    listed = F.schema_of_variant(F.variant_get(doc, _at(name), "variant")).startswith("ARRAY")
    return F.when(listed, F.try_variant_get(doc, f"{_at(name)}[0]", "string")).otherwise(text)


def byte_size(value: Column) -> Column:
    return F.octet_length(value)


def encoded(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))
