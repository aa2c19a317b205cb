"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to ``BITS`` bits, in its own order: sizes by quantiles over all rows; names by their
rank, spread evenly over the cells, or by quantiles of their rows if there are more names than cells. Rows are
sorted by the index of their cell on the Hilbert curve, and the order is cut into runs whose numbers
of rows differ by one at most (law ``rows``). Neighbours on the curve are neighbours in every dimension, so
the ranges in ``manifest`` let a reader skip shards by any of them.

Equal texts are groups: within a cell, rows are in order of the hash of their text, then of their id, so that copies
with the same names stand together, in one shard or, where the cut falls among them, in neighbours. A group is
never kept whole at the cost of the law.

Ranks are exact without sorting in one task: rows are range-partitioned by (curve index, hash of the
text, id, number of the row), which splits even copies of one row that are a third of all rows, and written with
their partition; the counts per partition (as many as partitions) give each its first rank.

Defined cases: a null text has size ``OVERHEAD`` and check sum 0; null names are a name of their own, before
all others; null ids take part; repeated rows take neighbouring places in any order; an empty table has no
shards; extra columns are ignored, or carried along if named in ``carry``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import scratch
from tessera.llm.texts import whole_text

OVERHEAD = 16
BITS = 5


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the curve of each row of ``cells`` (n x d), by Skilling's transform (2004)."""
    x = cells.astype(np.int64).copy()
    d = x.shape[1]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(d):
            on = (x[:, i] & bit) != 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(on, low, 0)
            x[:, 0] ^= swap
            x[:, i] ^= swap
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, d - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip[:, None]
    place = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            place = place << 1 | (x[:, i] >> level & 1)
    return place


def _curve(cells: list[Column], bits: int) -> Column:
    @F.pandas_udf("long")
    def index(*columns: pd.Series) -> pd.Series:
        return pd.Series(hilbert(np.stack([c.to_numpy() for c in columns], axis=1), bits))

    return index(*cells)


def _quantised(df: DataFrame, name: str, bits: int) -> Column:
    """The quantile of a number, from 0 to ``2 ** bits - 1``; null is 0."""
    parts = 1 << bits
    cuts = df.agg(
        F.percentile_approx(name, [k / parts for k in range(1, parts)], 10_000).alias("c")
    ).first()["c"]
    cuts = sorted(set(cuts or []))
    above = [F.when(F.col(name) > F.lit(c), 1).otherwise(0) for c in cuts]
    return sum(above, F.lit(0)).cast("long")


def _by_rank(df: DataFrame, name: str, bits: int) -> Column:
    """The place of a name among all names in sorted order, from 1 to ``2 ** bits - 1``; null is 0."""
    parts = 1 << bits
    names = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("__n"))
    few = [r[name] for r in names.select(name).orderBy(name).limit(parts).collect()]
    if len(few) < parts:
        cuts, cells = few[:-1], [(k + 1) * parts // (len(few) + 1) for k in range(len(few))]
    else:
        cuts = _weighted_cuts(names, name, parts - 1)
        cells = list(range(1, len(cuts) + 2))
    if not cells:
        return F.lit(0).cast("long")
    steps = [b - a for a, b in zip(cells, cells[1:], strict=False)]
    above = [F.when(F.col(name) > F.lit(c), step).otherwise(0) for c, step in zip(cuts, steps, strict=True)]
    return F.when(F.col(name).isNull(), 0).otherwise(sum(above, F.lit(cells[0]))).cast("long")


def _weighted_cuts(names: DataFrame, name: str, groups: int) -> list:
    """The last names of ``groups`` runs of names with about equal numbers of rows, ``__n`` each. A name that fills
    several runs ends them all."""
    spark = names.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = scratch.materialise(
        names.repartitionByRange(parts, name).withColumn("__part", F.spark_partition_id()), "shard-names"
    )
    sums = sorted((r["__part"], r["n"]) for r in placed.groupBy("__part").agg(F.sum("__n").alias("n")).collect())
    starts, total = _starts(sums)
    firsts = spark.createDataFrame(starts, "__part int, __first long")  # a row per partition
    through = F.col("__first") + F.sum("__n").over(Window.partitionBy("__part").orderBy(name))
    runs = placed.join(F.broadcast(firsts), "__part").withColumn("__to", through)
    ends = F.expr(f"(__to - __n) * {groups}L div {total}L < __to * {groups}L div {total}L") & (F.col("__to") < total)
    return sorted(r[name] for r in runs.where(ends).select(name).collect())


def _starts(counts: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], int]:
    """For each part the number of rows in the parts before, and the number of all."""
    starts, total = [], 0
    for part, n in counts:
        starts.append((part, total))
        total += n
    return starts, total


def assigned(
    docs: DataFrame, shards: int = 40, names: tuple[str, ...] = ("source", "lang"), bits: int = BITS,
    carry: tuple[str, ...] = (), text: str = "text", doc: str = "doc_id",
) -> DataFrame:
    """``(doc, size, text_crc32, shard, slot, curve)`` and the columns of ``names`` and ``carry``."""
    spark = docs.sparkSession
    kept = list(dict.fromkeys([doc, *names, *carry]))
    narrow = scratch.materialise(
        docs.select(
            *[F.col(c) for c in kept],
            (F.octet_length(whole_text(text)).cast("long") + OVERHEAD).alias("__size"),
            F.crc32(whole_text(text).cast("binary")).alias("__crc"),
            F.xxhash64(whole_text(text)).alias("__same"),
            F.monotonically_increasing_id().alias("__row"),
        ),
        "shard-rows",
    )
    by_rank = [_by_rank(narrow, n, bits) for n in names]
    curve = _curve([*by_rank, _quantised(narrow, "__size", bits)], bits)
    order = ["__curve", "__same", "__crc", doc, "__row"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = scratch.materialise(
        narrow.withColumn("__curve", curve)
        .repartitionByRange(parts, *order)
        .withColumn("__part", F.spark_partition_id()),
        "shard-order",
    )
    counts = sorted((r["__part"], r["n"]) for r in placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = _starts(counts)
    firsts = spark.createDataFrame(starts, "__part int, __first long")  # a row per partition
    within = Window.partitionBy("__part").orderBy(*order)
    rank = F.col("__first") + F.row_number().over(within) - 1
    ranked = placed.join(F.broadcast(firsts), "__part").withColumn("__rank", rank)
    exact = F.expr(f"__rank * {shards}L div {max(total, 1)}L")
    first = F.expr(f"(__shard * {total}L + {shards - 1}L) div {shards}L")
    return (
        ranked.withColumn("__shard", exact)
        .withColumn("__slot", F.col("__rank") - first)
        .select(
            *kept, F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"),
            F.col("__shard").cast("int").alias("shard"), F.col("__slot").cast("long").alias("slot"),
            F.col("__curve").alias("curve"),
        )
    )


def written(docs: DataFrame, path: str, shards: int = 40, names: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """Write all columns of ``docs`` as one folder per shard, rows in order of their slots; returns
    the manifest. Columns named like those of the result are replaced by it."""
    made = {"size", "text_crc32", "shard", "slot", "curve"}
    rest = tuple(c for c in docs.columns if c not in made)
    placed = assigned(docs, shards, names, carry=rest)
    placed.repartition(shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return manifest(docs.sparkSession.read.parquet(path), names)


def manifest(placed: DataFrame, names: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """Per shard the rows, bytes and the range of each dimension."""
    ranges = [f(c).alias(f"{label}_{c}") for c in (*names, "size") for label, f in (("min", F.min), ("max", F.max))]
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), *ranges)
