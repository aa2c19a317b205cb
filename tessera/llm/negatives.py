"""Hard negatives: for each anchor and positive, the best rows of another label in a window of scores below
the positive's.

Both searches, first for positives and then for negatives, are threshold joins in rounds. A round looks for rows
with a score of at least a threshold per anchor and window; windows that are not full go on to the next
round with a lower threshold, down to the lowest score that could count. Rows are dealt to parts of bounded
size. A part holds an inverted index: per segment of dimensions the rows that have it indexed. A row leaves out its
last segments as soon as their norm alone cannot lift any anchor of the block to its threshold. Partial scores
add up segment by segment; after each, rows are dropped whose partial score plus the product of the remaining
norms is below the threshold of every anchor. What is left is scored in full, in whole numbers.

Anchors go to every part, in batches; of each part only the first few rows per window come back, so no anchor
or label, however hot, brings more than that from a part.

Defined cases: rows without an id, a label or a vector, or with a null or non-finite component, take no part. Rows
with one id count as one, the least by (label, vector). Components are floor(256 x), held at +-2^22, so that every
score is exact; shorter vectors are padded by zeros. A positive with a negative score has an empty window. Empty
tables give no rows; extra columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera import scratch

SCALE = 256
MOST = 1 << 22

#: Numbers in a part's vectors, and rows of a part where there are few in all.
PART_NUMBERS = 1 << 22
SMALL_PART = 2048

#: Dimensions of a segment; rows and anchors scored at a time.
SEGMENT = 8
TILE = 8192
ANCHORS = 128

#: Thresholds as shares of the way from the highest to the lowest score of a window, round by round.
STEPS = (8, 4, 2, 1)

_FOUND = "anchor_id long, positive_id long, id long, score long"


def whole_numbers(embeddings: DataFrame, vec_id: str, label: Column, vector: str) -> DataFrame:
    """``(id, label, v)`` of the rows that take part, one per id."""
    fit = (
        F.col(vec_id).isNotNull() & label.isNotNull() & F.col(vector).isNotNull()
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    numbers = F.transform(vector, lambda x: F.greatest(
        F.least(F.floor(F.lit(SCALE) * F.greatest(F.least(x.cast("double"), F.lit(1e9)), F.lit(-1e9))), F.lit(MOST)), F.lit(-MOST)
    ))
    rows = embeddings.where(fit).select(F.col(vec_id).cast("long").alias("id"), label.alias("label"), numbers.alias("v"))
    return rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("one")).select("id", "one.label", "one.v")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    found = np.zeros((len(sizes), width))
    found[np.arange(width) < sizes[:, None]] = flat
    return found


class _Index:
    """The vectors of one part, in segments of dimensions, those with the most weight first."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.order = np.argsort(-(vectors**2).sum(axis=0), kind="stable")
        self.ids, self.labels, self.vectors = ids, labels, vectors[:, self.order]
        self.segments = range(0, vectors.shape[1], SEGMENT)
        self.norms = self.suffixes(self.vectors)

    def suffixes(self, vectors: np.ndarray) -> np.ndarray:
        """``[row, s]``: the norm from segment ``s`` on; 0 after the last."""
        squares = [(vectors[:, d : d + SEGMENT] ** 2).sum(axis=1) for d in self.segments]
        whole = np.zeros((len(vectors), len(self.segments) + 1))
        for s in range(len(squares) - 1, -1, -1):
            whole[:, s] = whole[:, s + 1] + squares[s]
        return np.sqrt(whole)

    def above(self, vectors: np.ndarray, least: np.ndarray):
        """Yield ``(rows, scores)`` where every row has a score of at least ``least`` with some vector, tile by tile.
        Other rows may be among them; ``scores`` is exact."""
        norms = self.suffixes(vectors)
        # Room for rounding in the bounds; scores themselves are whole numbers below 2 ** 53.
        bar = least - 1 - 1e-9 * norms[:, 0] * self.norms[:, 0].max(initial=0.0)
        reach = (bar / np.maximum(norms[:, 0], 1e-300)).min()
        # A row leaves out its last segments while their norm is below the reach; norms fall from left to right.
        kept = (self.norms[:, :-1] >= reach).sum(axis=1) if reach > 0 else np.full(len(self.ids), len(self.segments))
        listed = np.argsort(-kept, kind="stable")
        if reach > 0:
            listed = listed[: np.count_nonzero(kept)]
        for start in range(0, len(listed), TILE):
            rows = listed[start : start + TILE]
            sums = np.zeros((len(vectors), len(rows)))
            for s, d in enumerate(self.segments):
                have = np.count_nonzero(kept[rows] > s)
                if not have:
                    break
                some = rows[:have]
                sums[:, :have] += vectors[:, d : d + SEGMENT] @ self.vectors[some, d : d + SEGMENT].T
                best = sums[:, :have] + np.outer(norms[:, s + 1], self.norms[some, s + 1])
                alive = np.ones(len(rows), bool)
                alive[:have] = (best >= bar[:, None]).any(axis=0)
                if not alive.all():
                    rows, sums = rows[alive], sums[:, alive]
            if len(rows):
                yield rows, vectors @ self.vectors[rows].T


def _first(scores: np.ndarray, ids: np.ndarray, low: int, high: int, n: int) -> np.ndarray:
    """Places of the first ``n`` scores from ``high`` down to ``low``; both arrays are in order of rank."""
    start = np.searchsorted(-scores, -high)
    end = np.searchsorted(-scores, -low, side="right")
    return np.arange(start, min(end, start + n))


def _searched(index: _Index, anchors: dict, same: bool, take: int) -> list[tuple]:
    """``(anchor, positive, id, score)`` of the first ``take`` rows of this part in each window."""
    found = []
    vectors = anchors["vectors"][:, index.order]
    for start in range(0, len(vectors), ANCHORS):
        block = slice(start, start + ANCHORS)
        windows = anchors["windows"][block]
        least = np.array([min(w["low"] for w in ws) for ws in windows], np.float64)
        labels, ids = anchors["labels"][block], anchors["ids"][block]
        best: dict[tuple[int, int], list] = {}
        for rows, scores in index.above(vectors[block], least):
            alike = labels[:, None] == index.labels[rows][None, :]
            fit = alike & (ids[:, None] != index.ids[rows][None, :]) if same else ~alike
            a, r = np.nonzero(fit & (scores >= least[:, None]))
            score, row = scores[a, r].astype(np.int64), index.ids[rows[r]]
            order = np.lexsort((row, -score, a))
            a, score, row = a[order], score[order], row[order]
            ends = np.searchsorted(a, np.arange(len(windows) + 1))
            for i, ws in enumerate(windows):
                part = slice(ends[i], ends[i + 1])
                for k, w in enumerate(ws):
                    at = _first(score[part], row[part], w["low"], w["high"], take)
                    if len(at):
                        best.setdefault((i, k), []).extend(
                            zip((-score[part][at]).tolist(), row[part][at].tolist(), strict=True)
                        )
        for (i, k), rows in best.items():
            positive = windows[i][k]["positive_id"]
            found += [(int(ids[i]), positive, row, -score) for score, row in sorted(rows)[:take]]
    return found


def _probe(rows: DataFrame, open_anchors: DataFrame, parts: int, width: int, same: bool, take: int) -> DataFrame:
    """One round: all parts searched for all open anchors."""
    none = F.lit(None).cast(open_anchors.schema["windows"].dataType)
    indexed = rows.select(
        F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part"), F.lit(0).alias("kind"), "id", "label", "v", none.alias("windows")
    )
    asked = open_anchors.select(
        F.explode(F.expr(f"sequence(0L, {parts - 1}L)")).alias("part"), F.lit(1).alias("kind"),
        "id", "label", "v", "windows",
    )
    target = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        part, held, index = None, [], None
        for batch in batches:
            key = batch.column("part").to_numpy() * 2 + batch.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                piece = batch.slice(a, b - a)
                if key[a] // 2 != part:
                    part, held, index = key[a] // 2, [], None
                ids, labels = piece.column("id").to_numpy(), piece.column("label").to_numpy()
                if key[a] % 2 == 0:
                    held.append((ids, labels, _matrix(piece.column("v"), width)))
                    continue
                if index is None and held:
                    index, held = _Index(*(np.concatenate(x) for x in zip(*held, strict=True))), []
                if index is not None:
                    anchors = {
                        "ids": ids, "labels": labels, "vectors": _matrix(piece.column("v"), width),
                        "windows": piece.column("windows").to_pylist(),
                    }
                    found = _searched(index, anchors, same, take)
                    columns = zip(*found, strict=True) if found else [[]] * 4
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=target)

    dealt = indexed.unionByName(asked).repartition(parts, "part").sortWithinPartitions("part", "kind", "id")
    return dealt.mapInArrow(run, _FOUND)


def _ranked(found: DataFrame, take: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= take)


def _filled(rows: DataFrame, anchors: DataFrame, windows: DataFrame, parts: int, width: int, same: bool, take: int) -> DataFrame:
    """The first ``take`` rows of each window ``(anchor_id, positive_id, floor, top)``, ranked."""
    whole, paths = None, []
    high = F.col("top")
    for step in STEPS:
        low = F.col("top") - F.floor((F.col("top") - F.col("floor")) / step)
        asked = windows.withColumns({"low": low, "high": high}).where(F.col("low") <= F.col("high"))
        if whole is not None:
            counts = whole.groupBy("anchor_id", "positive_id").agg(F.count(F.lit(1)).alias("have"))
            asked = asked.join(counts, ["anchor_id", "positive_id"], "left").where(F.coalesce("have", F.lit(0)) < take)
        grouped = asked.groupBy("anchor_id").agg(
            F.collect_list(F.struct("positive_id", "low", "high")).alias("windows")
        )
        open_anchors, path = scratch.stored(
            anchors.join(grouped, F.col("id") == F.col("anchor_id")).select("id", "label", "v", "windows"), "open-anchors"
        )
        paths.append(path)
        if step != STEPS[0] and open_anchors.isEmpty():
            break
        found = _probe(rows, open_anchors, parts, width, same, take)
        found = _ranked(found, take).drop("rank")
        whole_now, path = scratch.stored(found if whole is None else whole.unionByName(found), "in-windows")
        whole = whole_now
        paths.append(path)
        # The next round takes up just below this one's threshold.
        high = low - 1
    result = scratch.materialise(_ranked(whole, take), "windows")
    for path in paths:
        scratch.drop(rows.sparkSession, path)
    return result


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: of each anchor its first
    ``positives`` other rows of its label, and for each of these the first ``negatives`` rows of another label whose score is
    ``low`` to ``high`` percent of the positive's. ``rows`` is ``(id, label, v)``, as ``whole_numbers`` makes it."""
    spark = rows.sparkSession
    rows = scratch.materialise(rows, "vectors")
    shape = rows.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"),
        F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)).alias("square"),
    ).first()
    width = max(1, shape["width"] or 1)
    busy = min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(shape["n"] / SMALL_PART))
    parts = max(1, busy, math.ceil(shape["n"] * width / PART_NUMBERS))
    longest = math.sqrt(shape["square"] or 0.0)

    anchors = scratch.materialise(rows.where(is_anchor), "anchors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    # Score 0 is halfway down from the highest to the lowest score there can be.
    most = F.ceil(norm * longest) + 1
    whole = anchors.select(
        F.col("id").alias("anchor_id"), F.col("id").alias("positive_id"), (-most).alias("floor"), most.alias("top")
    )
    liked = _filled(rows, anchors, whole, parts, width, True, positives).select(
        "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    score = F.col("positive_score")
    windows = liked.select(
        "anchor_id", "positive_id", (-F.floor(-low * score / 100)).alias("floor"), F.floor(high * score / 100).alias("top")
    ).where(F.col("floor") <= F.col("top"))
    disliked = _filled(rows, anchors, windows, parts, width, False, negatives)
    return disliked.join(liked, ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


def mined(
    embeddings: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding",
    every: int = 100, moved: int = 7, labels: int = 10,
) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by ``every``, after rows whose id is divisible by ``moved`` got the
    next of ``labels`` labels."""
    number = F.col(vec_id)
    label_of = F.when(number % moved == 0, (F.col(label) + 1) % labels).otherwise(F.col(label)).cast("long")
    return hard_negatives(whole_numbers(embeddings, vec_id, label_of, vector), F.col("id") % every == 0)
