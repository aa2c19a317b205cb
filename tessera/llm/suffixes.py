"""Suffix-array dedup: byte strings of ``length`` that start in more than one place.

Each block of segments (see ``repeats``) gets its suffixes sorted by bucket-pointer refinement: an
initial sort by q-grams points each suffix to its bucket; buckets of more than one suffix are refined
by the pointers found at a later offset, and the refined pointers serve the next step, so that the
depth doubles. The last offset is chosen so that the depth is exactly ``length``: what then shares a bucket
is the same string.

Defined cases: a null text is empty; texts below ``length`` bytes lose nothing; equal texts of at least
``length`` bytes lose everything; rows with a null id count as places like any other; repeated rows are
equal texts; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.repeats import BLOCK_BYTES, Bytes, Piece, keyed, shared_windows
from tessera.llm.texts import as_bytes, slices

LENGTH = 400
Q = 8


def buckets(data: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups of places with equal strings of ``depth`` bytes: ``(place, pointer)``, for buckets of more than one.

    ``ends`` is the end of the segment of each place; a string that crosses it is left out.
    """
    n = len(data)
    gram = np.zeros(n, np.uint64)
    wide = np.concatenate([data, np.zeros(Q, np.uint8)])
    q = min(Q, depth)
    for k in range(q):
        gram = gram << np.uint64(8) | wide[k : k + n]
    place = np.arange(n)
    live = place[place + q <= ends]
    pointer = np.zeros(n, np.int64)
    live = _refined(live, gram[live], np.zeros(len(live), np.int64) + len(live) - 1, pointer)
    done = q
    while done < depth:
        offset = min(done, depth - done)
        live = live[live + offset + done <= ends[live]]
        # Dead places may have left one place alone in its bucket; that only costs a comparison.
        key = pointer[live].astype(np.uint64) * np.uint64(n + 1) + pointer[live + offset].astype(np.uint64)
        live = _refined(live, key, pointer[live], pointer)
        done += offset
    return live, pointer[live]


def _refined(live: np.ndarray, key: np.ndarray, old: np.ndarray, pointer: np.ndarray) -> np.ndarray:
    """Point each place to the last place of its new bucket, within its old one; returns the places that
    are not alone."""
    if not len(live):
        return live
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(key)))
    last = np.repeat(starts + sizes - 1, sizes)
    before = old[order]
    edge = np.flatnonzero(np.concatenate([before[1:] != before[:-1], [True]]))
    end_of_old = edge[np.searchsorted(edge, np.arange(len(key)))]
    pointer[live[order]] = before - (end_of_old - last)
    return live[order][np.repeat(sizes, sizes) > 1]


def search(pieces: list[Piece], length: int) -> list[list[tuple[int, int, int]]]:
    """Runs of windows that start in more than one place."""
    if not pieces:
        return []
    sizes = np.array([len(p.data) for p in pieces])
    stops = np.cumsum(sizes)
    data = np.frombuffer(b"".join(p.data for p in pieces), np.uint8)
    live, pointer = buckets(data, np.repeat(stops, sizes), length)
    repeated = np.zeros(len(data) + 1, np.int8)
    _, inverse, times = np.unique(pointer, return_inverse=True, return_counts=True)
    repeated[live[times[inverse] > 1]] = 1
    several = np.array([p.copies > 1 for p in pieces])
    for a, b in zip((stops - sizes)[several].tolist(), stops[several].tolist(), strict=True):
        repeated[a : b - length + 1] = 1
    found = []
    edges = np.flatnonzero(np.diff(np.concatenate([[0], repeated])))
    starts, ends = edges[::2], edges[1::2]  # windows end before their segment does, so runs do not cross
    first = np.searchsorted(starts, stops - sizes).tolist()
    for (a, b), begin in zip(zip(first, [*first[1:], len(starts)], strict=True), (stops - sizes).tolist(), strict=True):
        found.append([(int(x) - begin, int(y - x), 0) for x, y in zip(starts[a:b], ends[a:b], strict=True)])
    return found


def removed(size: int, copies: int, runs: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """The maximal removed byte ranges of a text."""
    if size < length:
        return []
    if copies > 1:
        return [(0, size)]
    spans: list[tuple[int, int]] = []
    for a, b in sorted((r["pos"], r["pos"] + r["n"] - 1 + length) for r in runs or []):
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
        else:
            spans.append((a, b))
    return spans


def _cut(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]])


def deduplicated(
    docs: DataFrame, length: int = LENGTH, text: str = "text", doc: str = "doc_id", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``(doc, n_bytes, spans, kept)``: removed byte ranges, and the bytes that stay."""
    found = _found(docs, length, text, doc, block_bytes)

    def make(data: bytes, spans: list[tuple[int, int]]) -> tuple:
        return len(data), [{"start": a, "end": b} for a, b in spans], _cut(data, spans)

    kinds = [pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
    return _rows(found, doc, length, make, ["n_bytes", "spans", "kept"], kinds,
                 "n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def digests(
    docs: DataFrame, length: int = LENGTH, text: str = "text", doc: str = "doc_id", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``(doc, n_bytes, n_removed, n_spans, kept_sha256)``."""
    found = _found(docs, length, text, doc, block_bytes)

    def make(data: bytes, spans: list[tuple[int, int]]) -> tuple:
        gone = sum(b - a for a, b in spans)
        return len(data), gone, len(spans), hashlib.sha256(_cut(data, spans)).hexdigest()

    return _rows(found, doc, length, make, ["n_bytes", "n_removed", "n_spans", "kept_sha256"],
                 [pa.int64(), pa.int64(), pa.int64(), pa.string()],
                 "n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _found(docs: DataFrame, length: int, text: str, doc: str, block_bytes: int) -> DataFrame:
    return shared_windows(keyed(docs, text, doc), Bytes(length), lambda pieces: search(pieces, length), block_bytes)


def _rows(found: DataFrame, doc: str, length: int, make, names: list[str], kinds: list[pa.DataType], ddl: str):
    narrow = found.select("doc", "text", "copies", "runs")
    kind = narrow.schema["doc"].dataType.simpleString()

    def run(batches):
        for batch in slices(batches, "text"):
            rows = [
                make(data, removed(len(data), copies, runs, length))
                for data, copies, runs in zip(
                    as_bytes(batch.column("text")), batch.column("copies").to_pylist(),
                    batch.column("runs").to_pylist(), strict=True,
                )
            ]
            made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *made], names=[doc, *names])

    return narrow.mapInArrow(run, f"`{doc}` {kind}, {ddl}")
