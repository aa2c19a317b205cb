"""The Spark side of finding windows that occur in more than one place, for any unit of text.

A window is ``unit.window`` neighbouring units (bytes or words) of one text. The steps:

1. ``_anchored``: each text is cut into segments (see ``anchors``), and segments are kept whose anchor
   occurs elsewhere; these are some narrow rows per text.
2. ``_pieces``: the texts that have any hand out those segments; equal segments of a slice of texts
   are one row with its places.
3. ``_searched``: an anchor's segments meet in one task, which gathers small blocks of them and has
   ``search`` find the windows they share. Blocks and all arrays over them are bounded.
4. An anchor with more than ``BLOCK_BYTES`` of different segments is not searched there. Each of its different
   segments counts as a text of the next round, which cuts it by a longer gram (``_grams``); its places stay
   as one row each. Windows that share a gram differ in what is left of the window beside it, a quarter
   of the round before, so each round has a fraction of the windows. Those of the last round are compared
   by hashes of 128 bits. From round 1 on, a segment ends where its gram comes again (``_pieces_of``): periodic
   text is a few different segments, each with many places in one row, however long it is.
5. ``_resolved``: what a round found in a segment is joined back to the places of the segment, from the last
   round to the first.

Equal texts take part once, under the least id and the number of their copies. Texts are told apart by
96 bits of hashes, segments of large anchors by 128. Nothing depends on the order of rows, and every task
can be run again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any, NamedTuple, Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.anchors import Prefix, Segments, segments
from tessera.llm.texts import as_bytes, slices, whole_text

#: Different segments of at most so many bytes are searched together, unless one alone is longer.
BLOCK_BYTES = 1 << 20
SCAN_BYTES = 1 << 20


class Cut(NamedTuple):
    """Texts as one sequence of units: bytes of each, and hashes, begins and numbers of units."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    begins: np.ndarray
    lengths: np.ndarray


class Unit(Protocol):
    """``directed``: only windows that also start in a text with a smaller id are wanted."""

    window: int
    gram: int
    directed: bool

    def cut(self, texts: list[bytes]) -> Cut: ...


class Bytes:
    """Single bytes of UTF-8."""

    directed = False

    def __init__(self, window: int):
        self.window = window
        self.gram = min(64, window)

    def cut(self, texts: list[bytes]) -> Cut:
        data = np.frombuffer(b"".join(texts), np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        places = np.arange(len(data))
        begins = np.cumsum(lengths) - lengths
        return Cut(data, places, places + 1, data.astype(np.uint64) + np.uint64(1), begins, lengths)


class Words:
    """Runs of bytes other than ASCII white space."""

    directed = True

    def __init__(self, window: int):
        self.window = window
        self.gram = min(4, window)

    def cut(self, texts: list[bytes]) -> Cut:
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        space = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        stops = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        bounds = np.searchsorted(starts, np.concatenate([[0], stops]))
        hashes = Prefix(data.astype(np.uint64) + np.uint64(1)).ranges(starts, ends)
        return Cut(data, starts, ends, hashes, bounds[:-1], np.diff(bounds))


def cut_segments(unit: Unit, cut: Cut) -> Segments:
    return segments(Prefix(cut.hashes).grams(unit.gram), cut.begins, cut.lengths, unit.window, unit.gram)


def keyed(docs: DataFrame, text: str, doc: str) -> DataFrame:
    """``(doc, text, k, crc)``: a null text is empty; ``k`` and ``crc`` are hashes of the text."""
    return docs.select(F.col(doc).alias("doc"), whole_text(text).alias("text")).select(
        "doc", "text", F.xxhash64("text").alias("k"), F.crc32(F.col("text").cast("binary")).alias("crc")
    )


def _anchored(rows: DataFrame, unit: Unit, parts: int) -> DataFrame:
    """``(k, ords)``: the numbers of the segments of each text whose anchor occurs in other segments,
    or again in the same one."""

    def scan(batches):
        for batch in slices(batches, "text", SCAN_BYTES):
            keys, first = np.unique(batch.column("k").to_numpy(), return_index=True)  # copies count once
            cut = unit.cut([batch.column("text")[int(i)].as_py().encode() for i in first])
            found = cut_segments(unit, cut)
            ord_ = np.arange(len(found.row)) - np.searchsorted(found.row, found.row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.anchor.view(np.int64)), pa.array(keys[found.row]),
                 pa.array(np.where(found.again, ~ord_, ord_).astype(np.int32))],
                names=["anchor", "k", "ord"],
            )

    def shared(batches):
        # Sorted by anchor: an anchor's rows go out once two of them differ in text or place.
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, k, ord_ = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if held is not None:
                anchor, k, ord_ = (np.concatenate(x) for x in zip(held, (anchor, k, ord_), strict=True))
            edge = np.concatenate([[True], anchor[1:] != anchor[:-1]])
            starts = np.flatnonzero(edge)
            group = np.cumsum(edge) - 1
            differs = np.zeros(len(starts), bool)
            other = (k != k[starts][group]) | (ord_ != ord_[starts][group]) | (ord_ < 0)
            differs[group[other]] = True
            # All rows of the last anchor have gone out, or are the same; one stays as a witness.
            held = tuple(x[starts[-1] : starts[-1] + 1] for x in (anchor, k, ord_))
            keep = differs[group]
            yield _out(k[keep], ord_[keep])

    def _out(k, ord_):
        ord_ = np.where(ord_ < 0, ~ord_, ord_)
        return pa.RecordBatch.from_arrays([pa.array(k), pa.array(ord_.astype(np.int32))], names=["k", "ord"])

    return (
        rows.mapInArrow(scan, "anchor long, k long, ord int")
        .repartition(parts, "anchor").sortWithinPartitions("anchor")
        .mapInArrow(shared, "k long, ord int")
        .groupBy("k").agg(F.collect_set("ord").alias("ords"))
    )


class Piece(NamedTuple):
    """A segment: its bytes, the least id and the number (up to 2) of texts that hold it, and its
    places ``(k, crc, first units, id)``."""

    data: bytes
    least: int
    copies: int
    places: list[tuple[int, int, list[int], int]]


#: Gets the different segments of a block, by anchor; yields per segment ``(start, length, least)`` runs
#: of windows to report, counted in units from the segment's begin.
Search = Callable[[list[Piece]], Iterable[list[tuple[int, int, int]]]]

#: Places of one anchor that are held at once; beyond that its different segments go to the next round.
MOST_PLACES = 1 << 17

_PLACE = "struct<k:long,crc:long,pos:int,own:long>"
_PLACES = pa.list_(pa.struct([("k", pa.int64()), ("crc", pa.int64()), ("pos", pa.int32()), ("own", pa.int64())]))


def _pieces(texts: DataFrame, unit: Unit) -> DataFrame:
    """Rows ``(anchor, data, least, copies, places)`` from rows ``(text, k, crc, ords, least, copies)``."""

    def make(batches):
        for batch in slices(batches, "text", SCAN_BYTES):
            raw = as_bytes(batch.column("text"))
            cut = unit.cut(raw)
            found = cut_segments(unit, cut)
            ord_ = np.arange(len(found.row)) - np.searchsorted(found.row, found.row)
            ks, crcs, least, copies = (batch.column(c).to_pylist() for c in ("k", "crc", "least", "copies"))
            wanted = [
                np.isin(ord_[a:b], np.array(ords, np.int64))
                for ords, a, b in zip(
                    batch.column("ords").to_pylist(), *_bounds(found.row, len(raw)), strict=True
                )
            ]
            chosen = np.flatnonzero(np.concatenate(wanted)) if wanted else np.empty(0, np.int64)
            begin = cut.begins[found.row[chosen]]
            a = cut.starts[begin + found.first[chosen]]
            b = cut.ends[begin + found.last[chosen] + unit.window - 1]
            data = cut.data.tobytes()
            seen: dict[tuple[int, bytes], list] = {}
            for row, anchor, pos, x, y in zip(
                found.row[chosen].tolist(), found.anchor[chosen].view(np.int64).tolist(),
                found.first[chosen].tolist(), a.tolist(), b.tolist(), strict=True,
            ):
                held = seen.setdefault((anchor, data[x:y]), [least[row], 0, []])
                held[0] = min(held[0], least[row])
                held[1] += copies[row]
                held[2].append({"k": ks[row], "crc": crcs[row], "pos": pos, "own": least[row]})
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x for x, _ in seen], pa.int64()), pa.array([x for _, x in seen], pa.binary()),
                    pa.array([x[0] for x in seen.values()], pa.int64()),
                    pa.array([min(2, x[1]) for x in seen.values()], pa.int32()),
                    pa.array([x[2] for x in seen.values()], _PLACES),
                ],
                names=["anchor", "data", "least", "copies", "places"],
            )

    return texts.select("text", "k", "crc", "ords", "least", "copies").mapInArrow(
        make, f"anchor long, data binary, least long, copies int, places array<{_PLACE}>"
    )


def _bounds(row: np.ndarray, n: int) -> tuple[list[int], list[int]]:
    edges = np.searchsorted(row, np.arange(n + 1)).tolist()
    return edges[:-1], edges[1:]


#: Rows of three kinds, in texts of round ``level`` (from round 1 on, ``(k, crc)`` names a segment of the round before):
#: a run of ``n`` windows from ``pos``; with ``s``, a place of the segment ``(s, t)`` of a large anchor, its id in
#: ``least``; with ``anchor``, a segment to be searched, or in the last round a window by its hashes ``anchor`` and ``t``.
#: A place or a segment to be searched has more places in the same text in ``also``, as 32-bit numbers (an array column
#: would make each shuffle of these rows several times dearer).
_FOUND = (
    "level int, k long, crc long, pos int, n int, least long, s long, t long, copies int, anchor long, data binary, "
    "also binary"
)
_KINDS = [
    ("level", pa.int32()), ("k", pa.int64()), ("crc", pa.int64()), ("pos", pa.int32()), ("n", pa.int32()),
    ("least", pa.int64()), ("s", pa.int64()), ("t", pa.int64()), ("copies", pa.int32()), ("anchor", pa.int64()),
    ("data", pa.binary()), ("also", pa.binary()),
]
#: Places in one row.
_ROW_PLACES = 1 << 14


def _grams(unit: Unit) -> list[int]:
    """The grams of the rounds; after these, windows are compared whole."""
    grams = [unit.gram]
    for _ in range(2):
        longer = unit.window - (unit.window - grams[-1]) // 4
        if grams[-1] < longer < unit.window:
            grams.append(longer)
    return grams


def _pieces_of(unit: Unit, cut: Cut, gram: int) -> dict[tuple[int, bytes], list[int]]:
    """The first units of the different segments ``(anchor, bytes)`` of one text. All windows of a segment have the same
    first place of the anchor's gram, so it has at most ``window - gram + 1`` of them."""
    grams = Prefix(cut.hashes).grams(gram)
    found = segments(grams, cut.begins, cut.lengths, unit.window, gram)
    data, made = cut.data.tobytes(), {}
    for a, b, value, again in zip(found.first, found.last, found.anchor, found.again, strict=True):
        # A window that begins after a place of the gram has a later one as its first.
        inner = np.flatnonzero(grams[a:b] == value) + a if again else np.empty(0, np.int64)
        first, last = np.append(a, inner + 1), np.append(inner, b)
        anchor = int(value.view(np.int64))
        starts, ends = cut.starts[first], cut.ends[last + unit.window - 1]
        for pos, x, y in zip(first.tolist(), starts.tolist(), ends.tolist(), strict=True):
            made.setdefault((anchor, data[x:y]), []).append(pos)
    return made


def _packed(places: list[int]) -> bytes | None:
    """The places but the first, for a row."""
    return np.array(places[1:], np.int32).tobytes() or None


def _unpacked(pos: int, also: bytes | None) -> list[int]:
    return [pos, *np.frombuffer(also, np.int32).tolist()] if also else [pos]


def _joined(runs: Iterable[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs ``(pos, n, least)`` of one text; those of one id that touch are one."""
    made: list[tuple[int, int, int]] = []
    for pos, n, least in sorted(runs):
        if made and made[-1][2] == least and pos <= made[-1][0] + made[-1][1]:
            made[-1] = (made[-1][0], max(made[-1][1], pos + n - made[-1][0]), least)
        else:
            made.append((pos, n, least))
    return made


class _Rows:
    """Rows of ``_FOUND`` to be handed out as a batch."""

    def __init__(self):
        self.columns: list[list] = [[] for _ in _KINDS]
        self.size = 0

    def add(self, *values) -> None:
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)
        self.size += 64 + len(values[-2] or b"") + len(values[-1] or b"")

    def run(self, level: int, k: int, crc: int, pos: int, n: int, least: int) -> None:
        self.add(level, k, crc, pos, n, least, None, None, None, None, None, None)

    def full(self) -> bool:
        return self.size > 4 << 20

    def batch(self) -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, (_, t) in zip(self.columns, _KINDS, strict=True)], names=[n for n, _ in _KINDS]
        )
        self.__init__()
        return made


class _Blocks:
    """Gathers whole anchors to blocks for ``search``; cuts the segments of too large ones for the next round.
    Equal segments come one after the other."""

    def __init__(self, unit: Unit, search: Search, limit: int, level: int):
        self.unit, self.search, self.limit, self.level = unit, search, limit, level
        self.out = _Rows()
        self.block: dict[bytes, Piece] = {}
        self.group: dict[bytes, Piece] = {}  # the anchor being read
        self.size = self.group_size = self.group_places = 0
        self.current: Any = None
        self.large = False
        self.apart: Piece | None = None  # the segment of a large anchor being read, without its places

    def add(self, anchor: int, piece: Piece) -> None:
        if anchor != self.current:
            self._next_anchor()
            self.current = anchor
        if self.large:
            self._apart(piece)
            return
        held = self.group.get(piece.data)
        if held is None:
            self.group[piece.data] = piece
            self.group_size += len(piece.data)
        else:
            held.places.extend(piece.places)
            self.group[piece.data] = Piece(
                held.data, min(held.least, piece.least), min(2, held.copies + piece.copies), held.places
            )
        self.group_size += 16 * len(piece.places)
        self.group_places += sum(len(at) for _, _, at, _ in piece.places)
        if self.group_size > self.limit and len(self.group) > 1 or self.group_places > MOST_PLACES:
            for held in self.group.values():
                self._apart(held)
            self.group, self.group_size, self.large = {}, 0, True

    def _next_anchor(self) -> None:
        self._cut()
        if self.size + self.group_size > self.limit:
            self._search()
        # Segments of different anchors have no window in common, so none is equal.
        self.block.update(self.group)
        self.size += self.group_size
        self.group, self.group_size, self.group_places, self.large = {}, 0, 0, False

    def _search(self) -> None:
        pieces = list(self.block.values())
        for piece, runs in zip(pieces, self.search(pieces), strict=True):
            for k, crc, at, own in piece.places if runs else []:
                wanted = [x for x in runs if self.level or x[2] < own or not self.unit.directed]
                for run in _joined((pos + start, n, least) for pos in at for start, n, least in wanted):
                    self.out.run(self.level, k, crc, *run)
        self.block, self.size = {}, 0

    def _apart(self, piece: Piece) -> None:
        held = self.apart
        if held is not None and held.data == piece.data:
            self.apart = Piece(held.data, min(held.least, piece.least), min(2, held.copies + piece.copies), [])
        else:
            self._cut()
            self.apart = piece._replace(places=[])
        s, t = _name(piece.data)
        for k, crc, at, own in piece.places:
            self.out.add(self.level, k, crc, at[0], 0, own, s, t, None, None, None, _packed(at))

    def _cut(self) -> None:
        """The segment set apart as a text of the next round."""
        if self.apart is None:
            return
        piece, self.apart = self.apart, None
        k, crc = _name(piece.data)
        cut = self.unit.cut([piece.data])
        grams, level = _grams(self.unit), self.level + 1
        if level == len(grams):
            first = Prefix(cut.hashes).grams(self.unit.window).view(np.int64).tolist()
            other = Prefix(cut.hashes * np.uint64(0xC2B2AE3D27D4EB4F) ^ (cut.hashes >> np.uint64(7)))
            second = other.grams(self.unit.window).view(np.int64).tolist()
            for pos, (a, b) in enumerate(zip(first, second, strict=True)):
                self.out.add(level, k, crc, pos, 0, piece.least, None, b, piece.copies, a, None, None)
            return
        for (anchor, part), at in _pieces_of(self.unit, cut, grams[level]).items():
            copies = 2 if len(at) > 1 else piece.copies
            for i in range(0, len(at), _ROW_PLACES):
                some = at[i : i + _ROW_PLACES]
                self.out.add(level, k, crc, some[0], 0, piece.least, None, None, copies, anchor, part, _packed(some))

    def finish(self) -> None:
        self._next_anchor()
        self._search()


def _name(data: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(data)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def _searched(pieces: DataFrame, unit: Unit, search: Search, parts: int, block_bytes: int) -> DataFrame:
    """Rows of ``_FOUND``, from all rounds: runs and places."""

    def first_round(batches):
        blocks = _Blocks(unit, search, block_bytes, 0)
        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(5))
            for anchor, data, least, copies, places in zip(*columns, strict=True):
                held = [(p["k"], p["crc"], [p["pos"]], p["own"]) for p in places]
                blocks.add(anchor, Piece(data, least, copies, held))
                if blocks.out.full():
                    yield blocks.out.batch()
        blocks.finish()
        yield blocks.out.batch()

    def later_round(level: int):
        def run(batches):
            blocks = _Blocks(unit, search, block_bytes, level)
            for batch in batches:
                mine = batch.column("anchor").is_valid()
                yield batch.filter(pc.invert(mine))
                rows = batch.filter(mine)
                wanted = ("anchor", "data", "least", "copies", "k", "crc", "pos", "also")
                columns = (rows.column(c).to_pylist() for c in wanted)
                for anchor, data, least, copies, k, crc, pos, also in zip(*columns, strict=True):
                    blocks.add(anchor, Piece(data, least, copies, [(k, crc, _unpacked(pos, also), least)]))
                    if blocks.out.full():
                        yield blocks.out.batch()
            blocks.finish()
            yield blocks.out.batch()

        return run

    def last_round(batches):
        # Of equal windows the first row has the least id; it waits for a second row.
        window = least = held = None
        level = len(_grams(unit))
        for batch in batches:
            mine = batch.column("anchor").is_valid()
            yield batch.filter(pc.invert(mine))
            rows, out = batch.filter(mine), _Rows()
            wanted = ("anchor", "t", "least", "copies", "k", "crc", "pos")
            for a, b, low, copies, *place in zip(*(rows.column(c).to_pylist() for c in wanted), strict=True):
                if (a, b) != window:
                    window, least, held = (a, b), low, None
                    if copies < 2:
                        held = place
                        continue
                elif held is not None:
                    out.run(level, *held, 1, least)
                    held = None
                out.run(level, *place, 1, least)
            yield out.batch()

    found = pieces.repartition(parts, "anchor").sortWithinPartitions("anchor", "data").mapInArrow(first_round, _FOUND)
    for level in range(1, len(_grams(unit)) + 1):
        last = level == len(_grams(unit))
        order = ("anchor", "t", "least") if last else ("anchor", "data")
        found = (
            found.repartition(parts, F.coalesce("anchor", "k")).sortWithinPartitions(*order)
            .mapInArrow(last_round if last else later_round(level), _FOUND)
        )
    return found


def _resolved(found: DataFrame, unit: Unit, parts: int) -> DataFrame:
    """``(k, crc, pos, n, least)``: the runs of round 0, and those of later rounds at the places of their segments."""

    def back(level: int):
        def run(batches):
            segment, runs, open_ = None, [], False
            for batch in batches:
                place = pc.and_(pc.equal(batch.column("level"), level), batch.column("s").is_valid())
                mine = pc.or_(place, pc.equal(batch.column("level"), level + 1))
                yield batch.filter(pc.invert(mine))
                rows, out = batch.filter(mine), _Rows()
                wanted = ("k", "crc", "pos", "n", "least", "s", "t", "also")
                for k, crc, pos, n, least, s, t, also in zip(*(rows.column(c).to_pylist() for c in wanted), strict=True):
                    if n:  # the runs of a segment come before its places
                        if (k, crc) != segment:
                            segment, runs, open_ = (k, crc), [], True
                        runs.append((pos, n, least))
                    elif (s, t) == segment:
                        if open_:
                            runs, open_ = _joined(runs), False
                        mine = [x for x in runs if level or x[2] < least or not unit.directed]
                        for run in _joined((p + start, m, low) for p in _unpacked(pos, also) for start, m, low in mine):
                            out.run(level, k, crc, *run)
                        if out.full():
                            yield out.batch()
                yield out.batch()

        return run

    for level in range(len(_grams(unit)) - 1, -1, -1):
        place = (F.col("level") == level) & F.col("s").isNotNull()
        first, second = F.when(place, F.col("s")).otherwise(F.col("k")), F.when(place, F.col("t")).otherwise(F.col("crc"))
        found = (
            found.repartition(parts, first).sortWithinPartitions(first, second, place, "pos")
            .mapInArrow(back(level), _FOUND)
        )
    return found.select("k", "crc", "pos", "n", "least")


def shared_windows(
    rows: DataFrame, unit: Unit, search: Search, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``rows`` (see ``keyed``) with ``first`` (least id of equal texts), ``copies`` (rows with an equal text) and
    ``runs`` (null, or an array of ``pos, n, least``: windows that occur elsewhere too)."""
    parts = max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    texts = rows.groupBy("k", "crc").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("copies"))
    wanted = texts.join(_anchored(rows, unit, parts), "k")
    chosen = (
        rows.join(wanted, ["k", "crc"])
        # Not as an equality: that would become a join key, and the shuffle of texts one of its own.
        .where((F.col("doc") <= F.col("first")) | F.col("first").isNull())
        .select("text", "k", "crc", "ords", F.coalesce("first", F.lit((1 << 63) - 1)).alias("least"), "copies")
    )
    found = _searched(_pieces(chosen, unit), unit, search, parts, block_bytes)
    runs = (
        _resolved(found, unit, parts)
        .groupBy("k", "crc").agg(F.collect_list(F.struct("pos", "n", "least")).alias("runs"))
    )
    # One join with the texts, by the same keys as above, so that their shuffle is used again.
    return rows.join(texts.join(runs, ["k", "crc"], "left"), ["k", "crc"])
