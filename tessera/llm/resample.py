"""Importance resampling toward a target: documents drawn by how much their hashed word n-grams look
like those of a target set.

Texts lose the case of A to Z; words are runs of other characters than ASCII signs and blanks. Features are
all runs of one to three words joined by a blank; a feature falls into the bucket of its CRC. A CRC can be carried
on: that of "a b" comes from the state of "a" and the CRC of " b" alone, by a table per length, so whole arrays of
features are hashed at once.

The head of the vocabulary is sent to all tasks: CRC states of frequent words, and states and buckets of
frequent pairs. What is not in it is hashed directly. The head only saves work: totals and weights are the
same with any head, an empty one included.

Defined cases: a null or empty text has no words, weight 0 and no rank. Null is an id like any other; its draw is that of
an empty id, and it comes last among equal scores. Repeated rows are rows of their own; they tie, and have ranks one
after the other. Empty tables give no rows; with an empty target all its counts are 0. Extra columns are left
out. Very long texts pass in pieces with two words of context, so memory is bounded for texts of any length.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import scratch
from tessera.llm import texts

BUCKETS = 10_000

#: The head holds at most so many words, none longer than the tables, and as many pairs as find a free slot.
HEAD_WORDS = 1 << 16
HEAD_PAIRS = 1 << 16
SLOT_BITS = 18
#: A word or pair whose share of all is at least this is seen by the slice that has most of it.
SHARE = 1 / 20_000
LONGEST = 63

#: Text handled at once.
PIECE_BYTES = 4 << 20

_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def _advance_tables() -> np.ndarray:
    """``[n, k, b]``: what byte ``k`` of value ``b`` of a CRC becomes after ``n`` bytes of zero."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    rows = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])]
    for _ in range(LONGEST + 1):
        rows.append((rows[-1] >> np.uint32(8)) ^ step[rows[-1] & np.uint32(255)])
    return np.stack(rows)


_TABLES = _advance_tables().reshape(-1)


@dataclass(frozen=True)
class Head:
    """Frequent words with their place, and a table of frequent pairs with one slot per hash."""

    places: dict[bytes, int]
    alone: np.ndarray
    after: np.ndarray
    pair: np.ndarray
    pair_state: np.ndarray
    pair_bucket: np.ndarray

    @staticmethod
    def of(words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int) -> Head:
        """``pairs`` of such words, most frequent first; of two with one slot the first stays."""
        places = {w: i for i, w in enumerate(words)}
        alone = np.array([zlib.crc32(w) for w in words], np.uint32)
        after = np.array([zlib.crc32(b" " + w) for w in words], np.uint32)
        table = np.full(1 << SLOT_BITS, -1, np.int64)
        state, bucket = np.zeros(len(table), np.uint32), np.zeros(len(table), np.int64)
        for a, b in reversed(pairs):
            code = np.array([places[a] << 32 | places[b]], np.int64)
            slot, crc = _slots(code, SLOT_BITS)[0], zlib.crc32(a + b" " + b)
            table[slot], state[slot], bucket[slot] = code[0], crc, crc % buckets
        return Head(places, alone, after, table, state, bucket)


def _slots(codes: np.ndarray, bits: int) -> np.ndarray:
    return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass(frozen=True)
class Piece:
    """Words of several rows, one after the other: row and place in the row of each word. Words that are only
    context for the next have ``fresh`` unset."""

    words: list[bytes]
    row: np.ndarray
    place: np.ndarray
    fresh: np.ndarray


def _cuts(text: bytes) -> Iterator[bytes]:
    start = 0
    while start < len(text):
        end = start + PIECE_BYTES
        end = len(text) if end >= len(text) else text.find(b" ", end)
        end = len(text) if end < 0 else end
        yield text[start:end]
        start = end


def pieces(column: list[bytes]) -> Iterator[Piece]:
    """All words of all texts, in pieces of bounded size."""
    held, size = [], 0

    def made():
        sizes = np.array([len(w) for _, w, _, _ in held])
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return Piece(
            [w for _, words, _, _ in held for w in words],
            np.repeat(np.array([r for r, _, _, _ in held]), sizes),
            within + np.repeat(np.array([first for _, _, first, _ in held]), sizes),
            within >= np.repeat(np.array([context for _, _, _, context in held]), sizes),
        )

    for row, text in enumerate(column):
        seen, context = 0, []
        for cut in _cuts(text.translate(_FOLD)):
            fresh = cut.split()
            words = context + fresh
            if fresh:
                held.append((row, words, seen - len(context), len(context)))
                seen, context, size = seen + len(fresh), words[-2:], size + len(cut)
            if size >= PIECE_BYTES:
                yield made()
                held, size = [], 0
    if held:
        yield made()


def _advance(state: np.ndarray, after: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The CRC of a text with ``state``, a blank and a word, where ``after`` is that of blank and word."""
    row = size * 1024
    found = after.copy()
    for k in range(4):
        found ^= _TABLES[row + (256 * k) + (state >> np.uint32(8 * k) & np.uint32(255)).astype(np.int64)]
    return found


def hashed(piece: Piece, head: Head, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the runs of one, two and three words that end at each word; -1 where there is no such run."""
    encoded = pa.array(piece.words, pa.large_binary()).dictionary_encode()
    different, index = encoded.dictionary.to_pylist(), encoded.indices.to_numpy()
    known = np.array([head.places.get(w, -1) for w in different], np.int64)
    alone, after = np.zeros(len(known), np.uint32), np.zeros(len(known), np.uint32)
    inside = known >= 0
    alone[inside], after[inside] = head.alone[known[inside]], head.after[known[inside]]
    for i in np.flatnonzero(~inside):
        alone[i], after[i] = zlib.crc32(different[i]), zlib.crc32(b" " + different[i])
    size = np.array([len(w) + 1 for w in different], np.int64)
    long = size > LONGEST

    def carried(states: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The states of what ends just before the words ``at``, carried on over those words."""
        word = index[at]
        found = _advance(states, after[word], np.where(long[word], 0, size[word]))
        for i in np.flatnonzero(long[word]):
            found[i] = zlib.crc32(b" " + different[word[i]], int(states[i]))
        return found

    one, place = alone[index], known[index]
    second = np.flatnonzero(piece.place >= 1)
    second = second[second > 0]  # the first word of a piece is context at most
    second = second[piece.row[second - 1] == piece.row[second]]
    code = np.where((place[second - 1] >= 0) & (place[second] >= 0), place[second - 1] << 32 | place[second], -2)
    slot = _slots(code, len(head.pair).bit_length() - 1)
    frequent = head.pair[slot] == code
    two, two_bucket = np.zeros(len(index), np.uint32), np.full(len(index), -1, np.int64)
    two[second[frequent]] = head.pair_state[slot[frequent]]
    two_bucket[second[frequent]] = head.pair_bucket[slot[frequent]]
    rare = second[~frequent]
    two[rare] = carried(one[rare - 1], rare)
    two_bucket[rare] = two[rare] % np.uint32(buckets)
    third = second[piece.place[second] >= 2]
    third = third[two_bucket[third - 1] >= 0]
    three = np.full(len(index), -1, np.int64)
    three[third] = carried(two[third - 1], third) % np.uint32(buckets)
    return (one % np.uint32(buckets)).astype(np.int64), two_bucket, three


def _frequent(docs: DataFrame, text: str) -> DataFrame:
    """``(gram, words, n)``: words and pairs with a share of at least SHARE in some slice, and their counts there."""
    share = SHARE

    def run(batches):
        for batch in texts.slices(batches, text, PIECE_BYTES):
            grams, words, counts = [], [], []
            for piece in pieces(texts.as_bytes(batch.column(text))):
                encoded = pa.array(piece.words, pa.large_binary()).dictionary_encode()
                names, index = encoded.dictionary.to_pylist(), encoded.indices.to_numpy().astype(np.int64)
                least = max(1, math.ceil(share * len(index)))
                n = np.bincount(index, minlength=len(names))
                short = np.array([len(w) < LONGEST for w in names])
                for i in np.flatnonzero((n >= least) & short):
                    grams.append(names[i]), words.append(1), counts.append(int(n[i]))
                at = np.flatnonzero(piece.place[1:] >= 1) + 1
                at = at[short[index[at]] & short[index[at - 1]]]
                code, n = np.unique(index[at - 1] * len(names) + index[at], return_counts=True)
                for c, k in zip(code[n >= least].tolist(), n[n >= least].tolist(), strict=True):
                    grams.append(names[c // len(names)] + b" " + names[c % len(names)])
                    words.append(2), counts.append(k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams, pa.binary()), pa.array(words, pa.int32()), pa.array(counts, pa.int64())],
                names=["gram", "words", "n"],
            )

    return docs.select(text).mapInArrow(run, "gram binary, words int, n long")


def head_of(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> Head:
    """The most frequent words and pairs, found in one pass over all texts; at most HEAD_WORDS and HEAD_PAIRS
    rows reach the driver."""
    summed = scratch.materialise(
        _frequent(docs, text).groupBy("gram", "words").agg(F.sum("n").alias("n")), "head"
    )

    def most(words: int, limit: int) -> list[bytes]:
        ordered = summed.where(F.col("words") == words).orderBy(F.desc("n"), "gram").limit(limit)
        return [bytes(r["gram"]) for r in ordered.select("gram").collect()]

    words = most(1, HEAD_WORDS)
    known = set(words)
    pairs = [tuple(p.split(b" ")) for p in most(2, HEAD_PAIRS)]
    return Head.of(words, [p for p in pairs if p[0] in known and p[1] in known], buckets)


def totals(docs: DataFrame, head, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """The exact number of features in each bucket; ``head`` is broadcast. A task sends one row per bucket."""

    def run(batches):
        found = np.zeros(buckets, np.int64)
        for batch in texts.slices(batches, text, PIECE_BYTES):
            for piece in pieces(texts.as_bytes(batch.column(text))):
                for ends in hashed(piece, head.value, buckets):
                    found += np.bincount(ends[piece.fresh & (ends >= 0)], minlength=buckets)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], names=["bucket", "n"])

    parts = docs.select(text).mapInArrow(run, "bucket long, n long")
    whole = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        whole[row["bucket"]] = row["n"]
    return whole


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight, in thousandths."""
    all_source, all_target, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([
        math.floor(1000 * math.log(((t + 1) * (all_source + n)) / ((s + 1) * (all_target + n))))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)
    ], np.int64)


def weighted(docs: DataFrame, head, gain, text: str = "text", doc_id: str = "doc_id", buckets: int = BUCKETS) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` of each row; ``head`` and ``gain`` are broadcast."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in texts.slices(batches, "text", PIECE_BYTES):
            words, features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for piece in pieces(texts.as_bytes(batch.column("text"))):
                words += np.bincount(piece.row[piece.fresh], minlength=batch.num_rows)
                for ends in hashed(piece, head.value, buckets):
                    at = piece.fresh & (ends >= 0)
                    features += np.bincount(piece.row[at], minlength=batch.num_rows)
                    # Whole numbers far below 2 ** 53, so sums of doubles are exact.
                    sums = np.bincount(piece.row[at], weights=gain.value[ends[at]], minlength=batch.num_rows)
                    weight += sums.astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words), pa.array(features), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return narrow.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def _noise(doc_id: Column, seed: int) -> Column:
    """A Gumbel draw in thousandths, fixed by seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def ranked(scored: DataFrame, least_words: int, percent: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... for the ``percent`` highest scores among rows of at least
    ``least_words`` words, null for all others.

    Rows are dealt to ranges and written in order with their place; the driver sees one count per range.
    """
    spark = scored.sparkSession
    order = [
        F.col("n_words") < least_words, F.desc("score"), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("row"),
    ]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = scratch.materialise(
        scored.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id()),
        "resample-order",
    )
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = dealt.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_words") >= least_words).alias("able")
    ).orderBy("part").collect()
    firsts, before = [], 0
    for row in counts:
        firsts.append((row["part"], before))
        before += row["n"]
    drawn = percent * sum(row["able"] for row in counts) // 100
    offsets = spark.createDataFrame(firsts, "part long, before long")
    rank = F.col("before") + place + 1
    return (
        dealt.withColumn("part", part).join(F.broadcast(offsets), "part")
        .withColumn("rank", F.when(rank <= drawn, rank))
    )


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42,
    text: str = "text", doc_id: str = "doc_id", target_text: str = "text", buckets: int = BUCKETS,
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of each document; the drawn ones have a rank."""
    spark = docs.sparkSession
    head = spark.sparkContext.broadcast(head_of(docs, text, buckets))
    gain = spark.sparkContext.broadcast(
        gains(totals(docs, head, text, buckets), totals(target, head, target_text, buckets))
    )
    # Written once: repeated rows are told apart by a number that must not change when a task runs again.
    scored = scratch.materialise(
        weighted(docs, head, gain, text, doc_id, buckets)
        .withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed))
        .withColumn("row", F.monotonically_increasing_id()),
        "resample-scores",
    )
    head.unpersist()
    gain.unpersist()
    return ranked(scored, least_words, percent).select("doc_id", "n_features", "weight", "score", "rank")
