"""SimHash near-duplicates, found in the space of bit counts per segment.

Each fingerprint of 64 bits is mapped to the bit counts of its 32 two-bit segments. One bit
changes one count by one at most, so the Manhattan distance of two such vectors never exceeds
the Hamming distance of their fingerprints. The grid join uses that: cut the 32 axes into ``g``
groups; of two vectors within distance ``d`` at least ``g - d`` groups are equal, so the pair
shares the grid cell of one choice of ``g - d`` groups. Within a cell the distance of the counts is a
cheap filter and the exact bit distance decides.

``g`` follows from the number of distinct fingerprints (``plan``), so that cells stay small as data
grows; the links are the same for any ``g``. Equal fingerprints are one row from the start. A cell gives
a spanning forest of its links, never all pairs; a cell of more than ``BLOCK`` fingerprints is
compared block against block in as many tasks.

Defined cases: a null or blank text has fingerprint zero and links like any other; rows with a
null id take part, and a component of null ids only has a null id; repeated rows get equal
results; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera import scratch
from tessera.llm.texts import hexed, per_row, whole_text
from tessera.operators.components import stars
from tessera.operators.keyed import spread_group

SEED = 42
BLOCK = 1 << 16
SEGMENTS = 32
_LOW = 0x5555555555555555

#: Rows of a group of at most this size are compared by lag, larger ones by breadth-first search.
SMALL = 128


def fingerprint(text: bytes, shingle_words: int = 4) -> tuple[int]:
    """The SimHash of a text as a signed long."""
    words = text.lower().split()
    if not words:
        return (0,)
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        shingles = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-1]])[: len(words) - shingle_words + 1]
        ends = ends[shingle_words - 1 :] - 1
        shingles = [joined[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    hashes = np.fromiter(
        map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles)
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return (int(bits.view("<i8")[0]),)


def fingerprints(
    docs: DataFrame, shingle_words: int = 4, text: str = "text", doc: str = "doc_id", carry: tuple[str, ...] = ()
) -> DataFrame:
    """``(doc, *carry, fp)``, one row per row of ``docs``."""
    return per_row(docs, [doc, *carry], text, lambda x: fingerprint(x, shingle_words), "fp long")


def segment_counts(fp: np.ndarray) -> np.ndarray:
    """The 32 counts (0, 1 or 2) of the two-bit segments, in two bits each."""
    shifted = fp >> np.uint64(1)
    return ((fp ^ shifted) & np.uint64(_LOW)) | ((fp & shifted & np.uint64(_LOW)) << np.uint64(1))


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The distance of packed count vectors: 00, 01 and 10 differ from each other by 1 or 2."""
    d = a ^ b
    low, high = d & np.uint64(_LOW), (d >> np.uint64(1)) & np.uint64(_LOW)
    return np.bitwise_count(low) + 2 * np.bitwise_count(high & ~low)


def plan(n: int, distance: int) -> list[int]:
    """Masks over packed counts, one per choice of groups, for ``n`` distinct fingerprints.

    Two unrelated counts of a segment agree with probability 3/8. The number of groups is the one with
    the least estimated work: a row per choice and fingerprint, and the pairs that share a cell.
    """

    def work(groups: int) -> float:
        choices = comb(groups, groups - distance)
        shared = n * n / 2 * 0.375 ** (SEGMENTS * (groups - distance) / groups)
        return choices * (50 * n + shared)

    groups = min(range(distance + 2, distance + 6), key=work)
    bounds = [round(i * SEGMENTS / groups) for i in range(groups + 1)]
    parts = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(bounds, bounds[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(parts, groups - distance)]


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least member of the component of each of ``n`` nodes, from edges ``a``-``b``."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        following = label.copy()
        np.minimum.at(following, label[a], least)
        np.minimum.at(following, label[b], least)
        while True:
            jumped = following[following]
            if np.array_equal(jumped, following):
                break
            following = jumped
        if np.array_equal(following, label):
            return label
        label = following


def _close(a: np.ndarray, b: np.ndarray, ca: np.ndarray, cb: np.ndarray, distance: int) -> np.ndarray:
    near = manhattan(ca, cb) <= distance
    near[near] = np.bitwise_count((a ^ b)[near]) <= distance if a.shape == b.shape else np.bitwise_count(
        np.broadcast_to(a, near.shape)[near] ^ np.broadcast_to(b, near.shape)[near]
    ) <= distance
    return near


def cell_links(group: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(child, parent)`` by index that span all links within runs of equal ``group``."""
    n = len(fp)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(starts, n))
    ends = np.repeat(starts + sizes, sizes)
    counts = segment_counts(fp)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    active = np.flatnonzero(np.repeat(sizes, sizes) <= SMALL)
    for lag in range(1, SMALL):
        active = active[active + lag < ends[active]]
        if not len(active):
            break
        other = active + lag
        near = _close(fp[active], fp[other], counts[active], counts[other], distance)
        found.append((active[near], other[near]))
    for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        left = np.arange(start, start + size)
        while len(left):
            frontier, left = left[:1], left[1:]
            while len(frontier) and len(left):
                rows = max(1, (1 << 20) // len(left))
                block, frontier = frontier[:rows], frontier[rows:]
                near = _close(fp[block, None], fp[None, left], counts[block, None], counts[None, left], distance)
                hit = near.any(axis=0)
                found.append((block[near[:, hit].argmax(axis=0)], left[hit]))
                frontier, left = np.concatenate([frontier, left[hit]]), left[~hit]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    return a, b


def _forest(fp: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints as stars around the least (signed) one of each component."""
    values, index = np.unique(fp.view(np.int64)[np.concatenate([a, b])], return_inverse=True)
    root = roots(index[: len(a)], index[len(a) :], len(values))
    child = np.flatnonzero(root != np.arange(len(values)))
    return values[child], values[root[child]]


def links(distinct: DataFrame, distance: int = 4, block: int = BLOCK) -> DataFrame:
    """``(child, parent)`` between distinct fingerprints ``fp`` such that the components are those
    of all pairs within ``distance`` bits."""
    masks = plan(distinct.count(), distance)
    low = F.lit(_LOW)
    shifted = F.shiftrightunsigned("fp", 1)
    counts = F.col("fp").bitwiseXOR(shifted).bitwiseAND(low).bitwiseOR(
        F.shiftleft(F.col("fp").bitwiseAND(shifted).bitwiseAND(low), 1)
    )
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    cells = distinct.withColumn("__counts", counts).select(
        "fp",
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("choice"), F.col("__counts").bitwiseAND(F.lit(m)).alias("cell"))
            for i, m in enumerate(signed)
        ])).alias("c"),
    ).select("c.choice", "c.cell", "fp")
    large = (
        cells.groupBy("choice", "cell").agg(F.count(F.lit(1)).alias("__size"))
        .where(F.col("__size") > block)
        .select("choice", "cell", F.ceil(F.col("__size") / block).cast("int").alias("__blocks"))
    )
    large = scratch.materialise(large, "large-cells")
    if large.isEmpty():
        dealt = cells.withColumn("pair", F.lit(0))
    else:
        blocks = F.coalesce("__blocks", F.lit(1))
        own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
        dealt = (
            cells.join(large, ["choice", "cell"], "left")
            .withColumn("__own", own)
            .withColumn("__other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn(
                "pair",
                F.least("__own", "__other") * blocks + F.greatest("__own", "__other"),
            )
            .select("choice", "cell", "fp", "pair")
        )

    def search(batches):
        held: list[pa.RecordBatch] = []
        rows = 0

        def flush(table: pa.Table):
            fp = table.column("fp").to_numpy().view(np.uint64)
            group = table.column("group").to_numpy()
            a, b = cell_links(group, fp, distance)
            child, parent = _forest(fp, a, b)
            up, down = np.maximum(child, parent), np.minimum(child, parent)
            return pa.RecordBatch.from_arrays([pa.array(up), pa.array(down)], names=["child", "parent"])

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 1 << 16:
                table = pa.Table.from_batches(held)
                group = table.column("group").to_numpy()
                cut = int(np.searchsorted(group, group[-1]))  # the last cell may go on
                if cut:
                    yield flush(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                rows -= cut
        if rows:
            yield flush(pa.Table.from_batches(held))

    # Cells are told apart by a hash; two that share one only cost comparisons.
    grouped = dealt.select(F.xxhash64("choice", "cell", "pair").alias("group"), "fp")
    parts = max(8, int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (
        grouped.repartition(parts, "group")
        .sortWithinPartitions("group")
        .mapInArrow(search, "child long, parent long")
        .distinct()
    )


def _members(
    docs: DataFrame, shingle_words: int, distance: int, text: str, doc: str, carry: tuple[str, ...]
) -> DataFrame:
    """``(doc, *carry, fp, root, component_id)`` of each row; ``root`` is a fingerprint that tells the component."""
    made = scratch.materialise(fingerprints(docs, shingle_words, text, doc, carry), "fingerprints")
    first = scratch.materialise(made.groupBy("fp").agg(F.min(doc).alias("__first")), "distinct-fingerprints")
    found = stars(links(first.select("fp"), distance)).select(F.col("child").alias("fp"), "parent")
    rooted = first.join(found, "fp", "left").withColumn("__root", F.coalesce("parent", "fp"))
    least = rooted.groupBy(F.xxhash64("__root").alias("__spread"), "__root").agg(F.min("__first").alias("component_id"))
    members = rooted.select("fp", "__root").join(least.drop("__spread"), "__root")
    return made.join(members, "fp").select(doc, *carry, "fp", F.col("__root").alias("root"), "component_id")


def near_duplicates(
    docs: DataFrame, shingle_words: int = 4, distance: int = 4, text: str = "text", doc: str = "doc_id",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``(doc, *carry, fp, component_id)``: the least id among all documents linked, over any number of steps."""
    return _members(docs, shingle_words, distance, text, doc, carry).drop("root")


def representatives(docs: DataFrame, shingle_words: int = 4, distance: int = 4) -> DataFrame:
    """One row of each component, with all columns: the one with the least id, ids before null. Of rows with that
    id the one whose text has the least hash stays, and of rows with the same text any one. Components without any
    id keep a row too."""
    # Ids and texts as keys without nulls; texts of one id are told apart by 96 bits.
    text, key = whole_text(), ["__none", "__id", "__text64", "__text32"]
    marked = docs.withColumns({
        "__none": F.col("doc_id").isNull(), "__id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        "__text64": F.xxhash64(text), "__text32": F.crc32(text.cast("binary")),
    })
    found = scratch.materialise(
        _members(marked, shingle_words, distance, "text", "doc_id", tuple(key)).drop("fp", "component_id"), "members"
    )
    least = found.groupBy("root").agg(
        F.min(F.struct("__none", "doc_id", "__text64", "__text32", "__id")).alias("one")
    ).select("one.*")
    repeats = spread_group(found, key, F.count(F.lit(1)).alias("__rows"))
    kept = scratch.materialise(least.drop("doc_id").join(repeats, key), "representatives")
    rows = marked.join(kept, key)
    # Only rows that occur several times have to meet again; each task sends one of them at most. Both parts read
    # the same shuffle of the documents.
    once = rows.where(F.col("__rows") == 1)
    copies = Window.partitionBy(F.xxhash64(*key), *key).orderBy("__rows")
    again = rows.where(F.col("__rows") > 1).withColumn("__rank", F.row_number().over(copies)).where(F.col("__rank") == 1)
    return once.select(*docs.columns).unionByName(again.select(*docs.columns))


def with_hex(found: DataFrame) -> DataFrame:
    return found.withColumn("fingerprint", hexed(F.col("fp"))).drop("fp")
