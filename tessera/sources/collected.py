"""The raw collections kept merged: a base in hash buckets, and the batches that are not folded into it yet.

For each field the base holds the order of the message that set it, so folding a batch gives what a merge of all messages
ever would, whatever the cut into batches and the order in which they are folded. A fold reads the new batches and the
base buckets that have their keys. A batch that was folded twice, or written again by a retry, changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schema, scratch
from tessera.operators.merge import merge_stamped, stamp, stamped_fields
from tessera.sources import buckets, raw

_UNKNOWN_DDL = "fingerprint STRING, ord BIGINT, value STRING"


def _key(kind: str) -> str:
    return "fingerprint" if kind == schema.UNKNOWN else schema.column(schema.FRAGMENT_KEY[kind])


def _fields(kind: str) -> dict[str, str]:
    return {schema.column(f): f for f in schema.FRAGMENT_FIELDS[kind]}


def _ddl(kind: str) -> str:
    if kind == schema.UNKNOWN:
        return _UNKNOWN_DDL
    own = [f for f in _fields(kind) if f != _key(kind)]
    return ", ".join(
        [f"{_key(kind)} STRING, ord BIGINT, last_ord BIGINT", *[f"{f} STRING, {stamp(f)} BIGINT" for f in own]]
    )


def _first_values(rows: DataFrame) -> DataFrame:
    return rows.groupBy("fingerprint").agg(F.min("ord").alias("ord"), F.min_by("value", "ord").alias("value"))


def _changes(fragments: DataFrame, kind: str) -> DataFrame:
    rows = fragments.where(F.col("fragment_type") == kind)
    if kind == schema.UNKNOWN:
        return _first_values(rows)
    fields = _fields(kind)
    present = {c: F.array_contains("present", f) for c, f in fields.items()}
    return stamped_fields(rows, [_key(kind)], list(fields), "ord", present)


def _combine(kind: str) -> buckets.Combine:
    if kind == schema.UNKNOWN:
        return lambda stored, changes: _first_values(stored.unionByName(changes))
    return lambda stored, changes: merge_stamped(
        stored.unionByName(changes), [_key(kind)], list(_fields(kind)), "ord"
    )


def unfolded(spark: SparkSession, store: str) -> list[int]:
    """The batches that are written in full and not part of the base."""
    note = buckets.load(spark, f"{store}/base", buckets.latest(spark, f"{store}/base")).note
    return buckets.pending(note, raw.batches(spark, f"{store}/fragments"))


def fold(spark: SparkSession, store: str) -> int | None:
    """Fold all new batches into the base and return its version; None if there is nothing at all."""
    root = f"{store}/base"
    last, new = buckets.latest(spark, root), unfolded(spark, store)
    if not new:
        return last
    held = buckets.load(spark, root, last)
    fragments = raw.read_batches(spark, f"{store}/fragments", new)
    tables = dict(held.tables)
    for kind in [*schema.FRAGMENT_FIELDS, schema.UNKNOWN]:
        changes = scratch.materialise(_changes(fragments, kind), f"fold-{kind}")
        tables[kind] = buckets.update(
            changes, root, kind, [_key(kind)], _ddl(kind), held.tables.get(kind), _combine(kind)
        )
    version = 0 if last is None else last + 1
    buckets.commit(spark, root, version, tables, buckets.noted(held.note, new))
    return version


def collection(spark: SparkSession, store: str, kind: str) -> DataFrame:
    """One collection as of the last fold, in the columns of ``raw.merged``."""
    held = buckets.load(spark, f"{store}/base", buckets.latest(spark, f"{store}/base")).tables
    if kind not in held:
        return spark.createDataFrame([], _ddl(kind)).drop(*[stamp(f) for f in raw.FIELDS])
    return buckets.read(spark, f"{store}/base", held[kind]).drop(*[stamp(f) for f in raw.FIELDS])


def collections(spark: SparkSession, store: str) -> dict[str, DataFrame]:
    """The five typed collections, as the fuse plan takes them."""
    return {kind: collection(spark, store, kind) for kind in schema.FRAGMENT_FIELDS}
