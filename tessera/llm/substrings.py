"""Substring dedup: windows of words that also start in a document with a smaller id.

Each block of segments (see ``repeats``) is a shard with a compressed FM-index: the Burrows-Wheeler transform
of its word numbers in a wavelet matrix, whose bits are packed with counts per 64. The segments are
streamed against it by backward search, all windows of a block at a time. A window's interval narrows
word by word; how far it goes while more than one place is left is the matching statistic, and
windows that reach ``length`` words are reported, with the least id among the places of their interval.

Defined cases: a null text has no words; rows with a null id neither lose words nor take any from
others; rows with an equal id take nothing from each other; of equal texts the least id keeps what it has
first; repeated rows get equal results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.repeats import BLOCK_BYTES, Piece, Words, keyed, shared_windows
from tessera.llm.texts import as_bytes, slices

LENGTH = 13


class Bits:
    """Packed bits with their running counts."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.counts = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, upto: np.ndarray) -> np.ndarray:
        word = upto >> 6
        mask = (np.uint64(1) << (upto & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[word] + np.bitwise_count(self.words[word] & mask)


class Wavelet:
    """Counts of a symbol before a place, by one bit of the symbol per level."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(max(1, int(top).bit_length()) - 1, -1, -1):
            bits = (symbols >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(bits), int(len(bits) - bits.sum())))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
        every = np.arange(top + 1)
        self.first = self._down(every, np.zeros(len(every), np.int64))

    def _down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.ones(place)
            place = np.where(symbol >> shift & 1, zeros + ones, place - ones)
        return place

    def before(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self._down(symbol, place) - self.first[symbol]


class FMIndex:
    """Backward search over a sequence of numbers; suffixes are sorted by ``depth`` symbols, which is
    enough for patterns of that length."""

    def __init__(self, symbols: np.ndarray, depth: int):
        n, top = len(symbols), int(symbols.max(initial=0))
        rank = symbols.astype(np.int64)
        size = 1
        while size < depth:
            after = np.zeros(n, np.int64)
            after[: n - size] = rank[size:] + 1
            _, rank = np.unique(rank * (n + top + 2) + after, return_inverse=True)
            size *= 2
        order = np.argsort(rank, kind="stable")
        self.less = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 1))])
        self.wavelet = Wavelet(symbols[order - 1], top)

    def whole(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.less[symbol], self.less[symbol + 1]

    def extended(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of patterns with one symbol more in front."""
        both = self.wavelet.before(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.less[symbol] + both[: len(symbol)], self.less[symbol] + both[len(symbol) :]


def statistics(symbols: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Per window ``(matched, interval)``: the words from its end that also occur elsewhere, at most
    ``length``, and for whole matches the begin of the interval, else -1."""
    index = FMIndex(symbols, length)
    matched = np.zeros(len(starts), np.int64)
    interval = np.full(len(starts), -1)
    live = np.arange(len(starts))
    low, high = index.whole(symbols[starts + length - 1])
    for step in range(1, length + 1):
        more = high - low > 1
        live, low, high = live[more], low[more], high[more]
        matched[live] = step
        if step == length or not len(live):
            break
        low, high = index.extended(symbols[starts[live] + length - 1 - step], low, high)
    if step == length:
        interval[live] = low
    return matched, interval


def search(pieces: list[Piece], length: int) -> list[list[tuple[int, int, int]]]:
    """Runs of windows with the least id of all segments that hold them, where it is another's."""
    if not pieces:
        return []
    cut = Words(length).cut([p.data for p in pieces])
    sizes = cut.lengths
    _, number = np.unique(cut.hashes, return_inverse=True)
    # A zero ends each segment; no window crosses it.
    begins = cut.begins + np.arange(len(pieces))
    symbols = np.zeros(len(number) + len(pieces), np.int64)
    symbols[np.arange(len(number)) + np.repeat(np.arange(len(pieces)), sizes)] = number + 1
    windows = sizes - length + 1
    owner = np.repeat(np.arange(len(pieces)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    _, interval = statistics(symbols, begins[owner] + offset, length)
    least = np.array([p.least for p in pieces])[owner]
    whole = np.flatnonzero(interval >= 0)
    lowest = np.full(len(symbols) + 1, np.iinfo(np.int64).max)
    np.minimum.at(lowest, interval[whole], least[whole])
    value = least.copy()
    value[whole] = np.minimum(least[whole], lowest[interval[whole]])
    shown = (value < least) | np.array([p.copies > 1 for p in pieces])[owner]
    kept = np.flatnonzero(shown)
    found: list[list[tuple[int, int, int]]] = [[] for _ in pieces]
    if len(kept):
        new = np.ones(len(kept), bool)
        new[1:] = (kept[1:] != kept[:-1] + 1) | (value[kept[1:]] != value[kept[:-1]]) | (owner[kept[1:]] != owner[kept[:-1]])
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(kept)))
        head = kept[at]
        for who, start, n, low in zip(owner[head].tolist(), offset[head].tolist(), count.tolist(), value[head].tolist(), strict=True):
            found[who].append((start, n, low))
    return found


def remaining(text: bytes, doc: int | None, first: int | None, runs: list[dict] | None, length: int) -> tuple[int, list[bytes]]:
    """The number of words of a text, and the words that stay."""
    words = text.split()
    if doc is None or len(words) < length:
        return len(words), words
    if doc != first:
        return len(words), []
    runs = [r for r in runs or [] if r["least"] < doc]
    if not runs:
        return len(words), words
    gone = bytearray(len(words))
    for r in runs:
        a, b = r["pos"], r["pos"] + r["n"] - 1 + length
        gone[a:b] = b"\1" * (b - a)
    return len(words), [w for w, g in zip(words, gone, strict=True) if not g]


def _made(docs: DataFrame, length: int, text: str, doc: str, block_bytes: int, make, names, kinds, ddl) -> DataFrame:
    found = shared_windows(keyed(docs, text, doc), Words(length), lambda pieces: search(pieces, length), block_bytes)
    narrow = found.select("doc", "text", "first", "runs")
    kind = narrow.schema["doc"].dataType.simpleString()

    def run(batches):
        for batch in slices(batches, "text"):
            columns = (batch.column(c).to_pylist() for c in ("doc", "first", "runs"))
            rows = [
                make(*remaining(raw, own, first, runs, length))
                for raw, own, first, runs in zip(as_bytes(batch.column("text")), *columns, strict=True)
            ]
            made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *made], names=[doc, *names])

    return narrow.mapInArrow(run, f"`{doc}` {kind}, {ddl}")


def deduplicated(
    docs: DataFrame, length: int = LENGTH, text: str = "text", doc: str = "doc_id", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``(doc, n_words, n_removed, kept)``: the words that stay, joined by spaces."""

    def make(n: int, words: list[bytes]) -> tuple:
        return n, n - len(words), b" ".join(words).decode()

    return _made(docs, length, text, doc, block_bytes, make, ["n_words", "n_removed", "kept"],
                 [pa.int64(), pa.int64(), pa.string()], "n_words long, n_removed long, kept string")


def digests(
    docs: DataFrame, length: int = LENGTH, text: str = "text", doc: str = "doc_id", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``(doc, n_words, n_removed, kept_sha256)``."""

    def make(n: int, words: list[bytes]) -> tuple:
        return n, n - len(words), hashlib.sha256(b" ".join(words)).hexdigest()

    return _made(docs, length, text, doc, block_bytes, make, ["n_words", "n_removed", "kept_sha256"],
                 [pa.int64(), pa.int64(), pa.string()], "n_words long, n_removed long, kept_sha256 string")
