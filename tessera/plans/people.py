"""People kept merged while records come in: connected components that grow with each batch.

Three tables in hash buckets hold what a batch needs of all records before it. ``values`` points from each identifying
value to the label of the people that have it, ``people`` holds per label the merged fields with the record that set
each, and ``labels`` points from a label that lost its people to the label they went to. A label is the least record
id of its people. A batch looks up its own values, links its records and the labels found, contracts these links to
stars, and merges the rows of the labels that were hit. No record or value that the batch does not touch is
read for its own sake, and people of any size are one row.

Each batch makes a version of its own number from the last one below it, so a batch that is run again gives the same
state. Record ids are whole numbers, each in one batch only; batches may bring them in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import scratch
from tessera.operators.components import stars, value_links
from tessera.operators.keyed import spread_group
from tessera.operators.melt import link_columns, melt
from tessera.operators.merge import stamp
from tessera.schema import FIELD_OF, IDENTIFYING_KEYS
from tessera.sources import buckets

_LABELS = "label BIGINT, newer BIGINT"


def _people_ddl(fields: list[str]) -> str:
    return "component BIGINT, records BIGINT, " + ", ".join(f"{f} STRING, {stamp(f)} BIGINT" for f in fields)


def _roots(root: str, labels: buckets.Table | None, found: DataFrame) -> DataFrame:
    """``(label, root)``: the label that each of these labels has come to, hop by hop."""
    spark = found.sparkSession
    current = scratch.materialise(found.select("label", F.col("label").alias("root")), "roots")
    while labels is not None:
        newer = buckets.lookup(spark, root, labels, current.select(F.col("root").alias("label")), _LABELS)
        hops = newer.withColumnRenamed("label", "root")
        following = scratch.materialise(
            current.join(hops, "root", "left").select(
                "label", F.coalesce("newer", "root").alias("root"), F.col("newer").isNotNull().alias("moved")
            ),
            "roots",
        )
        current = following.drop("moved")
        if following.where("moved").isEmpty():
            break
    return current


def _merged(rows: DataFrame, fields: list[str]) -> DataFrame:
    return rows.groupBy("component").agg(
        F.sum("records").alias("records"),
        *[e for f in fields for e in (F.max_by(f, stamp(f)).alias(f), F.max(stamp(f)).alias(stamp(f)))],
    )


def advance(
    records: DataFrame, root: str, version: int, record_id: str, fields: list[str],
    keys: list[str] = IDENTIFYING_KEYS, link_mode: str = "key_value", present: str | None = None,
) -> None:
    """Take in one batch of records, as version ``version``; the options are those of ``group_records``."""
    spark = records.sparkSession
    held = buckets.load(spark, root, buckets.latest(spark, root, version)).tables
    on = link_columns(link_mode)
    values_ddl = ", ".join([*[f"{c} STRING" for c in on], "label BIGINT"])

    records = scratch.materialise(records, "records")
    melted = melt(records, record_id, keys).select(record_id, *on)
    asked = scratch.materialise(spread_group(melted, on, F.min(record_id).alias("first")), "values")
    stored = buckets.lookup(spark, root, held.get("values"), asked, values_ddl)
    known = scratch.materialise(asked.join(stored, on, "left"), "known-values")
    roots = _roots(root, held.get("labels"), known.where(F.col("label").isNotNull()).select("label").distinct())

    # From the first record of the batch with a known value to the label of that value; a star inside the batch.
    across = known.join(roots, "label").where(F.col("first") != F.col("root")).select(
        F.greatest("first", "root").alias("child"), F.least("first", "root").alias("parent")
    )
    found = stars(value_links(melted, record_id, on).unionByName(across).distinct())

    def placed(df: DataFrame, node: str, alias: str) -> DataFrame:
        """``df`` with the label that ``node`` has after this batch."""
        star = found.select(F.col("child").alias(node), F.col("parent").alias("__parent"))
        return df.join(star, node, "left").withColumn(alias, F.coalesce("__parent", node)).drop("__parent")

    roots = scratch.materialise(placed(roots, "root", "newer"), "roots-now")

    def has(f: str):
        return F.array_contains(present, FIELD_OF.get(f, f)) if present else F.col(f).isNotNull()

    fresh = placed(records, record_id, "component").select(
        "component", F.lit(1).cast("long").alias("records"),
        *[e for f in fields for e in (F.col(f), F.when(has(f), F.col(record_id)).alias(stamp(f)))],
    )
    before = buckets.lookup(
        spark, root, held.get("people"), roots.select(F.col("root").alias("component")), _people_ddl(fields)
    )
    moved = roots.select(F.col("root").alias("component"), "newer").distinct()
    before = before.join(moved, "component").drop("component").withColumnRenamed("newer", "component")
    after = _merged(fresh.unionByName(before), fields)
    emptied = moved.where(F.col("component") != F.col("newer")).select("component", F.lit(0).cast("long").alias("records"))
    put = buckets.replaced(["component"])
    people = buckets.update(
        scratch.materialise(after.unionByName(emptied, allowMissingColumns=True), "people"),
        root, "people", ["component"], _people_ddl(fields), held.get("people"),
        lambda stored, changes: put(stored, changes).where(F.col("records") > 0),
    )
    labels = buckets.update(
        scratch.materialise(roots.select("label", "newer").unionByName(roots.select(F.col("root").alias("label"), "newer"))
                            .where(F.col("label") != F.col("newer")).distinct(), "labels"),
        root, "labels", ["label"], _LABELS, held.get("labels"),
    )
    now = placed(known, "first", "now").where(F.col("label").isNull() | (F.col("label") != F.col("now")))
    values = buckets.update(
        scratch.materialise(now.select(*on, F.col("now").alias("label")), "values-now"),
        root, "values", on, values_ddl, held.get("values"),
    )
    buckets.commit(spark, root, version, {"people": people, "labels": labels, "values": values})


def people(spark: SparkSession, root: str, fields: list[str], version: int | None = None) -> DataFrame:
    """``(component, records, fields)`` as of a version, or the latest: what ``group_records`` gives for all records so
    far."""
    number = buckets.latest(spark, root) if version is None else version
    held = buckets.load(spark, root, number).tables
    if "people" not in held:
        return spark.createDataFrame([], _people_ddl(fields)).select("component", "records", *fields)
    return buckets.read(spark, root, held["people"]).select("component", "records", *fields)
