"""Benchmark decontamination: passages of benchmark items inside documents, found within an edit budget.

Texts are compared as UTF-8 bytes after folding: A-Z become a-z, every run of ASCII characters other
than letters and digits becomes one space, other bytes stay. Each item is cut into passages of
``PASSAGE`` bytes every ``PASSAGE / 2`` (the last one ends with the item; a shorter item is one passage), and into windows
of ``WINDOW`` bytes every ``STRIDE`` for excerpts that have no whole passage. A document holds a
passage or window if a part of it is within ``floor(len / EDIT_SHARE)`` edits (insert, delete, replace) of it.
Of an item of at least ``WINDOW`` bytes every excerpt of ``WINDOW + STRIDE - 1`` = 79 bytes is found for certain, of a
shorter one the whole. Items shorter than ``MIN_ITEM`` are found without edits only, as whole words.

1. Q-gram lemma: a part within k edits shares at least ``len + 1 - q * (k + 1)`` q-grams with the
   passage, and all of them lie on at most 2k + 1 neighbouring diagonals (place in the document less place
   in the passage). Documents are scanned for q-grams of the benchmark; the hits are counted in
   bands of ``BAND`` diagonals that overlap by ``2k + 1``, so that some band has them all.
2. Bands that reach the bound are retained as regions.
3. Each region is verified by banded alignment: edit distance with free ends in the document, over
   the band's diagonals only.

The benchmark is scanned for in blocks of whole items, of ``BLOCK_BYTES`` of folded text (one item may be longer); the
items of one block are what is sent to the executors. Their index holds each q-gram once per place in the items, whatever
the passages that overlap there. A block is one pass over the documents. An item is never cut, so the
result is the same for any size of blocks.

Defined cases: null or blank items and items shorter than ``Q`` folded bytes are never found (one or two words, they
would match clean documents); null texts hold nothing; rows with a null id give hits with a null id;
repeated rows give equal hits, repeated items a hit each; extra columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.texts import as_bytes, slices

Q = 12
PASSAGE = 128
WINDOW = 64
STRIDE = 16
EDIT_SHARE = 16
BAND = 64
MIN_ITEM = 40
BLOCK_BYTES = 2 << 20

#: So much text is scanned at a time; arrays of eight bytes per byte are held for it.
SCAN_BYTES = 1 << 20

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[~_ALNUM] = 32

#: Hashed q-grams are looked up in a bit table first.
_BITS = 22
_MIX = np.uint64(0x9E3779B97F4A7C15)


def folded(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes and the place of each in ``text``."""
    low = _FOLD[text]
    space = low == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    places = np.flatnonzero(keep)
    return low[places], places


def grams(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first eight and the last four bytes of each q-gram, as two integers: no hashing."""
    n = len(text) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    wide = np.zeros(len(text) + 8, np.uint8)
    wide[: len(text)] = text
    four = wide[: len(text)].astype(np.uint64)
    for step in (1, 2):  # 2 bytes, then 4
        four = four | (np.concatenate([four[step:], np.zeros(step, np.uint64)]) << np.uint64(8 * step))
    eight = four[:n] | (four[4 : n + 4] << np.uint64(32))
    return eight, four[8 : n + 8]


def _key(eight: np.ndarray, four: np.ndarray) -> np.ndarray:
    """One integer per q-gram; verified by alignment, so that a clash only costs time."""
    x = (eight ^ (four * np.uint64(0xD6E8FEB86659FD93))) * _MIX
    return x ^ (x >> np.uint64(29))


class Passage(NamedTuple):
    #: The number of the item in its block.
    item: int
    start: int
    text: np.ndarray
    edits: int
    window: bool = False

    @property
    def needed(self) -> int:
        return max(1, len(self.text) + 1 - Q * (self.edits + 1))


def item_bytes(text: bytes) -> bytes:
    """An item as it is looked for; empty if it is too short."""
    body = folded(np.frombuffer(text, np.uint8))[0].tobytes().strip()
    return body if len(body) >= Q else b""


def passages(item: int, text: bytes) -> list[Passage]:
    body = np.frombuffer(item_bytes(text), np.uint8)
    if len(body) < MIN_ITEM:
        return [Passage(item, 0, body, 0)] if len(body) >= Q else []
    starts = [*range(0, len(body) - PASSAGE, PASSAGE // 2), max(0, len(body) - PASSAGE)]
    size = min(len(body), PASSAGE)
    found = [Passage(item, s, body[s : s + size], size // EDIT_SHARE) for s in starts]
    if len(body) > WINDOW:
        starts = [*range(0, len(body) - WINDOW, STRIDE), len(body) - WINDOW]
        found += [Passage(item, s, body[s : s + WINDOW], WINDOW // EDIT_SHARE, True) for s in starts]
    return found


class Index:
    """The q-grams of a block of items: a bit table, and sorted keys with their places in the items, which stand one
    after the other. The passages are sorted by their start there, whole ones and windows apart."""

    def __init__(self, items: list[bytes]):
        self.passages = [p for number, text in enumerate(items) for p in passages(number, text)]
        bodies = [np.frombuffer(item_bytes(x), np.uint8) for x in items]
        offsets = np.cumsum([0, *map(len, bodies)])
        self.edits = np.array([p.edits for p in self.passages], np.int64)
        self.needed = np.array([p.needed for p in self.passages], np.int64)
        self.size = np.array([len(p.text) for p in self.passages], np.int64)
        self.start = np.array([offsets[p.item] + p.start for p in self.passages], np.int64)
        window = np.array([p.window for p in self.passages], bool)
        self.kinds = [
            at[np.argsort(self.start[at], kind="stable")] for at in (np.flatnonzero(~window), np.flatnonzero(window))
        ]
        keys = [_key(*grams(x)) for x in bodies]
        every = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        places = np.concatenate([o + np.arange(len(k)) for o, k in zip(offsets, keys)]) if keys else np.empty(0, np.int64)
        order = np.argsort(every, kind="stable")
        every, self.place = every[order], places[order].astype(np.int64)
        self.keys, self.first = np.unique(every, return_index=True)
        self.many = np.diff(np.append(self.first, len(every)))
        self.table = np.zeros(1 << _BITS, bool)
        self.table[self.keys & np.uint64((1 << _BITS) - 1)] = True

    def lookup(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hits ``(place in text, passage, place in passage)``."""
        key = _key(*grams(text))
        at = np.flatnonzero(self.table[key & np.uint64((1 << _BITS) - 1)])
        row = np.searchsorted(self.keys, key[at])
        row[row == len(self.keys)] = 0
        same = self.keys[row] == key[at] if len(self.keys) else np.zeros(len(at), bool)
        at, row = at[same], row[same]
        source, many = _ranges(self.first[row], self.many[row])
        at, spot = np.repeat(at, many), self.place[source]
        found = []
        for kind, longest in zip(self.kinds, (PASSAGE, WINDOW), strict=True):
            starts = self.start[kind]
            low = np.searchsorted(starts, spot - (longest - Q))
            which, many = _ranges(low, np.searchsorted(starts, spot, side="right") - low)
            owner, where = kind[which], np.repeat(spot, many)
            place = where - self.start[owner]
            inside = place + Q <= self.size[owner]  # passages of the item before may end earlier
            found.append((np.repeat(at, many)[inside], owner[inside], place[inside]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _ranges(first: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``many[i]`` numbers from ``first[i]`` on, for all i; and ``many``."""
    within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(first, many) + within, many


def regions(index: Index, at: np.ndarray, owner: np.ndarray, place: np.ndarray):
    """``(passage, first diagonal, commonest diagonal)`` of the bands with as many hits as the lemma
    asks for."""
    if not len(at):
        return
    edits = index.edits[owner]
    diagonal = at - place + PASSAGE  # never negative
    # Bands start every BAND diagonals and reach 2k + 1 into the next.
    own = diagonal // BAND
    early = (diagonal % BAND < 2 * edits + 1) & (own > 0)
    band = np.concatenate([own, own[early] - 1])
    who = np.concatenate([owner, owner[early]])
    # A q-gram that repeats in the passage or the document counts once per place in the document.
    where = np.concatenate([at, at[early]])
    order = np.lexsort([where, band, who])
    who, band, where = who[order], band[order], where[order]
    new_band = np.concatenate([[True], (who[1:] != who[:-1]) | (band[1:] != band[:-1])])
    new_place = new_band | np.concatenate([[True], where[1:] != where[:-1]])
    starts = np.flatnonzero(new_band)
    sizes = np.add.reduceat(new_place.astype(np.int64), starts)
    ends = np.append(starts[1:], len(who))
    along = np.concatenate([diagonal, diagonal[early]])[order] - PASSAGE
    for k in np.flatnonzero(sizes >= index.needed[who[starts]]).tolist():
        # Within k edits the hits lie on k + 1 neighbouring diagonals, so some such run has enough.
        near = np.sort(along[starts[k] : ends[k]])
        reach = np.searchsorted(near, near + index.passages[who[starts[k]]].edits, side="right")
        if (reach - np.arange(len(near))).max() < index.needed[who[starts[k]]]:
            continue
        values, times = np.unique(near, return_counts=True)
        yield int(who[starts[k]]), int(band[starts[k]]) * BAND - PASSAGE, int(values[times.argmax()])


def align(passage: np.ndarray, text: np.ndarray, first: int, width: int, edits: int):
    """Least edit distance of ``passage`` to a part of ``text`` on ``width`` diagonals from ``first``.

    Returns ``(distance, start, end)`` or None beyond ``edits``. Cell ``d`` of a row is the diagonal
    ``first + d``: deleting from the passage moves down a diagonal, inserting moves up.
    """
    far = 1 << 20
    diagonals = np.arange(width)
    cost = np.where((first + diagonals >= 0) & (first + diagonals <= len(text)), 0, far)
    start = first + diagonals
    for i, wanted in enumerate(passage):
        place = first + diagonals + i
        inside = (place >= 0) & (place < len(text))
        got = np.where(inside, text[np.clip(place, 0, len(text) - 1)], -1)
        step = np.where(inside, cost + (got != wanted), far)
        down = np.append(cost[1:], far) + 1  # a byte of the passage is not in the text
        origin = np.where(down < step, np.append(start[1:], 0), start)
        best = np.minimum(step, down)
        ends = place + 1
        best = np.where((ends >= 0) & (ends <= len(text)), best, far)
        # A byte of the text is not in the passage: moves to the right along the row.
        run = np.minimum.accumulate(best - diagonals)
        source = np.maximum.accumulate(np.where(best - diagonals == run, diagonals, -1))
        through = run + diagonals
        origin = np.where(through < best, origin[source], origin)
        if best.min() > edits:
            return None
        cost, start = np.where((ends >= 0) & (ends <= len(text)), np.minimum(best, through), far), origin
    found = int(cost.argmin())
    if cost[found] > edits:
        return None
    return int(cost[found]), int(start[found]), int(first + found + len(passage))


def whole_words(passage: np.ndarray, text: np.ndarray, first: int, width: int):
    """The first place of ``passage`` as whole words on ``width`` diagonals from ``first``, as ``align`` gives it."""
    size = len(passage)
    for at in range(max(0, first), min(first + width, len(text) - size + 1)):
        if (
            np.array_equal(text[at : at + size], passage)
            and (at == 0 or not _ALNUM[text[at - 1]])
            and (at + size == len(text) or not _ALNUM[text[at + size]])
        ):
            return 0, at, at + size
    return None


class Block(NamedTuple):
    ids: list
    items: list[bytes]


def blocks(items: DataFrame, item: str, text: str, limit: int):
    """The items, whole, in blocks of about ``limit`` bytes. Read through an iterator: the driver holds one block at a
    time."""
    held, size = Block([], []), 0
    for row in items.select(item, text).orderBy(item).toLocalIterator():
        body = item_bytes((row[1] or "").encode())
        if body:
            held.ids.append(row[0])
            held.items.append(body)
            size += len(body)
        if size >= limit:
            yield held
            held, size = Block([], []), 0
    if held.items:
        yield held


def hits(
    docs: DataFrame, items: DataFrame, text: str = "text", doc: str = "doc_id",
    item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(doc, item, edits, start, end)`` for each document that holds a passage of an item.

    ``start`` and ``end`` are byte places in the text of the passage with the fewest edits, or of the
    window with the fewest where no passage is found.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(doc), F.col(text).alias("__text"))
    kind = narrow.schema[doc].dataType.simpleString()
    item_kind = items.schema[item].dataType
    item_type = to_arrow_type(item_kind)
    result = f"`{doc}` {kind}, `{item}` {item_kind.simpleString()}, edits int, start long, `end` long"
    whole = spark.createDataFrame([], result)
    for block in blocks(items, item, item_text, block_bytes):
        sent = spark.sparkContext.broadcast(block)

        def scan(batches, sent=sent):
            index = Index(sent.value.items)
            for batch in slices(batches, "__text", SCAN_BYTES):
                out: dict[str, list] = {c: [] for c in ("id", "item", "edits", "start", "end")}
                ids = batch.column(0)
                texts = as_bytes(batch.column(1))
                for row, (number, *found) in scanned(index, texts):
                    out["id"].append(row)
                    out["item"].append(sent.value.ids[number])
                    for name, value in zip(("edits", "start", "end"), found, strict=True):
                        out[name].append(value)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(out["id"], pa.int64())),
                        pa.array(out["item"], item_type),
                        pa.array(out["edits"], pa.int32()),
                        pa.array(out["start"], pa.int64()),
                        pa.array(out["end"], pa.int64()),
                    ],
                    names=[doc, item, "edits", "start", "end"],
                )

        whole = whole.unionByName(narrow.mapInArrow(scan, result))
    return whole


def scanned(index: Index, texts: list[bytes]):
    """``(row, hit)`` over a slice of texts; all are folded and looked up in one pass.

    A zero byte stands between texts: it is no part of any passage, so nothing matches across it.
    """
    raw = np.frombuffer(b"\0".join(texts), np.uint8)
    low, places = folded(raw)
    # A break folds to a space like other ASCII; it is put back where it was kept, or added.
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    bounds = np.searchsorted(places, begins)
    at, owner, place = index.lookup(low)
    row = np.searchsorted(bounds, at, side="right") - 1
    ends = np.append(bounds[1:], len(low))
    inside = at + Q <= ends[row]
    at, owner, place, row = at[inside], owner[inside], place[inside], row[inside]
    # Bands can only reach the bound where the whole text does.
    _, pair, times = np.unique(row * np.int64(len(index.passages) + 1) + owner, return_inverse=True, return_counts=True)
    enough = times[pair] >= index.needed[owner]
    at, owner, place, row = at[enough], owner[enough], place[enough], row[enough]
    if not len(row):
        return
    order = np.argsort(row, kind="stable")
    at, owner, place, row = at[order], owner[order], place[order], row[order]
    cuts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(row)], strict=True):
        number = int(row[a])
        begin, end = int(bounds[number]), int(ends[number])
        text = low[begin:end]
        best: dict[int, tuple[bool, int, int, int]] = {}
        for which, first, likely in regions(index, at[a:b] - begin, owner[a:b], place[a:b]):
            passage = index.passages[which]
            held = best.get(passage.item)
            if held and (held[1] == 0 or passage.window > held[0]):
                continue
            size = len(passage.text)
            if not passage.edits:
                hit = whole_words(passage.text, text, first, BAND + 1)
            elif likely >= 0 and np.array_equal(text[likely : likely + size], passage.text):
                hit = (0, likely, likely + size)
            else:
                width = BAND + 4 * passage.edits + 1
                hit = align(passage.text, text, first - passage.edits, width, passage.edits)
            if hit and (not held or (passage.window, *hit) < held):
                best[passage.item] = (passage.window, *hit)
        for item, (_, edits, start, stop) in best.items():
            own = places[begin:end] - begins[number]
            last = int(own[stop - 1]) + 1 if stop > 0 else 0
            yield number, (item, edits, int(own[min(start, len(own) - 1)]), last)


def clean(
    docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id",
    item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents that hold no passage of any item, as they are. Each row is judged on its own:
    rows pass through one scan per block of the benchmark, without a shuffle."""
    for block in blocks(items, item, item_text, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def keep(batches, sent=sent):
            index = Index(sent.value.items)
            for batch in slices(batches, text, SCAN_BYTES):
                bad = {row for row, _ in scanned(index, as_bytes(batch.column(text)))}
                yield batch.filter(pa.array([row not in bad for row in range(batch.num_rows)]))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
