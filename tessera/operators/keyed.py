"""First rows, lookups and numbering by key, for keys that may be very hot.

A lookup table that was just reduced by its key is already partitioned by it, and a join would
reuse that partitioning. Adaptive execution splits a hot partition only where both sides of a
join come straight from a shuffle, so reuse would leave a hot key to one task. The reductions
here therefore shuffle by ``(hash, key)``: the groups are the same, but a join on the key
alone shuffles both sides afresh, and its hot partitions can be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import scratch

_SPREAD = "__spread"


def spread_group(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """Group by ``keys`` such that a later join on them can split hot keys."""
    return df.groupBy(F.xxhash64(*keys).alias(_SPREAD), *keys).agg(*aggregates).drop(_SPREAD)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key; null keys are left out, as no join can meet them.

    The rank filter is applied before the shuffle as well, so that a hot key sends at most
    ``n`` rows per task.
    """
    window = Window.partitionBy(_SPREAD, *keys).orderBy(*order)
    return (
        df.dropna(subset=keys)
        .withColumn(_SPREAD, F.xxhash64(*keys))
        .withColumn("__rank", F.row_number().over(window))
        .where(F.col("__rank") <= n)
        .drop(_SPREAD, "__rank")
    )


def numbered(df: DataFrame, order: str, alias: str, start: int = 0) -> DataFrame:
    """Add consecutive ids from ``start + 1`` in the order of a unique integer column, dense or not.

    Rows are dealt to ranges of about equal size and written with the number of their range; the driver
    sees one count per range.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = scratch.materialise(
        df.repartitionByRange(parts, order).withColumn("__part", F.spark_partition_id()), "numbered"
    )
    counts = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).orderBy("__part").collect()
    firsts, total = [], start
    for row in counts:
        firsts.append((row["__part"], total))
        total += row["n"]
    before = spark.createDataFrame(firsts, "__part int, __before long")
    within = Window.partitionBy("__part").orderBy(order)
    return (
        dealt.join(F.broadcast(before), "__part")
        .withColumn(alias, F.col("__before") + F.row_number().over(within))
        .drop("__part", "__before")
    )
