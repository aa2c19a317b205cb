"""Repeats within a time to live, counted from the last accepted row of the same key."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera import scratch
from tessera.schema import DEDUP_SECONDS

_KEY, _AT, _ORDER = "__key", "__at", "__order"

#: Keys with more moments than this are split over tasks.
HOT_MOMENTS = 1 << 20


def ttl_dedup(
    df: DataFrame, keys: list[str], ts: str, order: str, ttl_seconds: int = DEDUP_SECONDS,
    hot_moments: int = HOT_MOMENTS,
) -> DataFrame:
    """The accepted rows: the first of each key, then each first row that comes at least
    ``ttl_seconds`` after the last accepted one. ``order`` is a unique integer and breaks ties. Null
    is a key like any other; rows without a time are left out, as nothing can be said of them
    (``untimed`` gives them).

    Of each key and moment only the first row is kept before the shuffle. The sorted moments of a key stream
    through a fold that holds one time. Keys of more than ``hot_moments`` moments are split by time instead
    (``_jumped``), so that no task has to hold all of a key; the result is the same. A moment carries the row's
    ``order``, which alone meets the full rows again.
    """
    ttl = ttl_seconds * 1_000_000
    moments = scratch.materialise(
        df.select(
            F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias(_KEY),
            F.unix_micros(F.col(ts).cast("timestamp")).alias(_AT),
            F.col(order).cast("bigint").alias(_ORDER),
        )
        .where(F.col(_AT).isNotNull())
        .groupBy(F.xxhash64(_KEY).alias("__hash"), _KEY, _AT)
        .agg(F.min(_ORDER).alias(_ORDER))
        .drop("__hash"),
        "moments",
    )
    hot = scratch.materialise(
        moments.groupBy(_KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_moments).select(_KEY), "hot-keys"
    )
    if hot.isEmpty():
        accepted = _folded(moments, ttl)
    else:
        accepted = _folded(moments.join(hot, _KEY, "left_anti"), ttl).unionByName(
            _jumped(moments.join(hot, _KEY, "left_semi"), ttl)
        )
    accepted = scratch.materialise(accepted.withColumnRenamed(_ORDER, order), "accepted")
    return df.join(accepted, order, "left_semi")


def untimed(df: DataFrame, ts: str) -> DataFrame:
    """The rows that ``ttl_dedup`` can neither accept nor call repeats, with the reason."""
    return df.where(F.col(ts).isNull()).withColumn("reason", F.lit("no time"))


def _folded(moments: DataFrame, ttl: int) -> DataFrame:
    """The accepted moments' orders, by one pass over each key in order of time."""

    def fold(batches):
        current = last = None
        for batch in batches:
            at, number = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            runs = pc.run_end_encode(batch.column(0))
            ends, names = runs.run_ends.to_pylist(), runs.values.to_pylist()
            taken: list[int] = []
            for name, a, b in zip(names, [0, *ends], ends, strict=False):
                if name != current:
                    current, last = name, None
                times = at[a:b]
                place = 0 if last is None else int(np.searchsorted(times, last + ttl))
                while place < len(times):
                    taken.append(a + place)
                    last = int(times[place])
                    place = int(np.searchsorted(times, last + ttl))
            yield pa.RecordBatch.from_arrays([pa.array(number[taken])], names=[_ORDER])

    parts = int(moments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        moments.select(_KEY, _AT, _ORDER).repartition(parts, _KEY).sortWithinPartitions(_KEY, _AT)
        .mapInArrow(fold, f"{_ORDER} bigint")
    )


def _following(moments: DataFrame, ttl: int) -> DataFrame:
    """``(key, at, next)``: the first moment of the key at least ``ttl`` after each one, null after the last.

    Time is cut into slices as long as ``ttl``. What follows a moment is the first at its place or later in the next
    slice, or else the first of the first slice after that. So each slice of a key meets the one before it, and a
    table with one row per slice gives the rest.
    """
    placed = moments.select(
        _KEY, _AT, F.expr(f"{_AT} div {ttl} - IF({_AT} % {ttl} < 0, 1, 0)").alias("slice"),
        F.pmod(_AT, F.lit(ttl)).alias("place"),
    )
    both = placed.select(_KEY, "slice", "place", F.col(_AT).alias("held"), F.lit(None).cast("bigint").alias(_AT)).unionByName(
        placed.select(_KEY, (F.col("slice") + 1).alias("slice"), "place", F.lit(None).cast("bigint").alias("held"), _AT)
    )
    backwards = Window.partitionBy(_KEY, "slice").orderBy(F.desc("place")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    near = both.withColumn("near", F.min("held").over(backwards)).where(F.col(_AT).isNotNull())
    by_slice = Window.partitionBy(_KEY).orderBy("slice")
    firsts = placed.groupBy(_KEY, "slice").agg(F.min(_AT).alias("first"))
    firsts = firsts.select(
        _KEY, (F.col("slice") + 1).alias("slice"),
        F.when(F.lead("slice").over(by_slice) > F.col("slice") + 1, F.lead("first").over(by_slice))
        .otherwise(F.lead("first", 2).over(by_slice)).alias("far"),
    )
    return near.join(firsts, [_KEY, "slice"]).select(_KEY, _AT, F.coalesce("near", "far").alias("next"))


def _jumped(moments: DataFrame, ttl: int) -> DataFrame:
    """The accepted moments' orders, by pointers from each moment to the one that would follow it, doubled round by
    round: after n rounds the first 2^n accepted moments of each key are known. At most one moment per slice is
    accepted, so the rounds grow with the logarithm of the time covered, not with the rows."""
    spark = moments.sparkSession
    steps, path = scratch.stored(_following(moments, ttl), "jumps")
    seen = scratch.materialise(moments.groupBy(_KEY).agg(F.min(_AT).alias(_AT)), "reached")
    while True:
        reached = seen.join(steps, [_KEY, _AT]).where(F.col("next").isNotNull()).select(_KEY, F.col("next").alias(_AT))
        more = scratch.materialise(reached.join(seen, [_KEY, _AT], "left_anti"), "reached")
        if more.isEmpty():
            break
        seen = scratch.materialise(seen.unionByName(more), "reached")
        hops = steps.select(_KEY, F.col(_AT).alias("next"), F.col("next").alias("after"))
        doubled, following = scratch.stored(
            steps.where(F.col("next").isNotNull()).join(hops, [_KEY, "next"]).select(_KEY, _AT, F.col("after").alias("next")),
            "jumps",
        )
        scratch.drop(spark, path)
        steps, path = doubled, following
    scratch.drop(spark, path)
    return moments.join(seen, [_KEY, _AT], "left_semi").select(_ORDER)
