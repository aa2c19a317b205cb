"""Files that are one JSON array each, read by many tasks.

The text reader deals a file to tasks by bytes; with ``}`` as its line separator, every object ends where a piece
of text ends. Whether a brace counts depends on what stands before it, so there are two passes: the first
takes from each split how it changes the state, (inside a string, depth), for both ways it may begin; folded over
the splits of a file, this gives the state in which each begins. The second cuts the objects out. An object
that crosses splits is put together from its parts, by the split it begins in.

The driver holds one small row per split, as it does to plan the scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_TOKEN = re.compile(r'"(?:[^"\\]++|\\.)*+("?)|[{}\[\]]', re.DOTALL)
_REST_OF_STRING = re.compile(r'(?:[^"\\]++|\\.)*+("?)', re.DOTALL)

#: Objects of an array stand at this depth.
_INSIDE_ARRAY = 1


def _marks(piece: str, quoted: bool) -> Iterator[tuple[int, int]]:
    """``(place, step)`` of the brackets outside strings; at last ``(-1, 1)`` if the piece ends in a string."""
    at = 0
    if quoted:
        rest = _REST_OF_STRING.match(piece)
        if not rest[1]:
            yield -1, 1
            return
        at = rest.end()
    for token in _TOKEN.finditer(piece, at):
        if token[1] is None:
            yield token.start(), 1 if token[0] in "{[" else -1
        elif not token[1]:
            yield -1, 1


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("lineSep", "}").text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    )


def _splits(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str]]]:
    """The pieces of each split, in order, each with the brace that ended it."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    row = next(rows, None)
    while row is not None:
        split = row[:2]

        def texts():
            nonlocal row
            while row is not None and row[:2] == split:
                yield row[2] + "}"
                row = next(rows, None)

        yield *split, texts()


def _effects(pieces: DataFrame) -> DataFrame:
    """Per split and way it may begin: ``(file, block, quoted, to_quoted, step)``."""

    def run(batches):
        for file, block, texts in _splits(batches):
            ways = [[False, 0], [True, 0]]
            for piece in texts:
                for way in ways:
                    quoted = False
                    for place, step in _marks(piece, way[0]):
                        if place < 0:
                            quoted = True
                        else:
                            way[1] += step
                    way[0] = quoted
            yield pa.RecordBatch.from_pydict(
                {"file": [file] * 2, "block": [block] * 2, "quoted": [False, True], "to_quoted": [w[0] for w in ways],
                 "step": [w[1] for w in ways]}
            )

    return pieces.mapInArrow(run, "file string, block long, quoted boolean, to_quoted boolean, step long")


def _begins(pieces: DataFrame) -> dict[tuple[str, int], tuple[bool, int]]:
    """How each split begins: whether inside a string, and its depth."""
    effects: dict[tuple[str, int], dict[bool, tuple[bool, int]]] = {}
    for row in _effects(pieces).collect():
        effects.setdefault((row.file, row.block), {})[row.quoted] = (row.to_quoted, row.step)
    begins = {}
    last, quoted, depth = None, False, 0
    for file, block in sorted(effects):
        if file != last:
            last, quoted, depth = file, False, 0
        begins[file, block] = (quoted, depth)
        quoted, step = effects[file, block][quoted]
        depth += step
    return begins


_PART = "file string, block long, head boolean, tail boolean, value string"
_KINDS = [("file", pa.string()), ("block", pa.int64()), ("head", pa.bool_()), ("tail", pa.bool_()), ("value", pa.string())]


def _parts(pieces: DataFrame, begins: dict[tuple[str, int], tuple[bool, int]]) -> DataFrame:
    """Whole elements, and parts of those that cross splits: ``head`` if the element began in an earlier split,
    ``tail`` if it goes on in the next."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, (_, k) in zip(columns, _KINDS, strict=True)], names=[n for n, _ in _KINDS]
        )

    def run(batches):
        for file, block, texts in _splits(batches):
            quoted, depth = begins[file, block]
            head = opened = depth > _INSIDE_ARRAY
            held: list[str] = []
            rows: list[tuple] = []
            size = 0
            for piece in texts:
                start, unclosed = 0, False
                for place, step in _marks(piece, quoted):
                    if place < 0:
                        unclosed = True
                        continue
                    if step > 0 and depth == _INSIDE_ARRAY:
                        opened, start = True, place
                    depth += step
                    if step < 0 and depth == _INSIDE_ARRAY and opened:
                        held.append(piece[start : place + 1])
                        rows.append((file, block, head, False, "".join(held)))
                        size += len(rows[-1][-1])
                        opened, head, held = False, False, []
                if opened:
                    held.append(piece[start:])
                quoted = unclosed
                if size > 1 << 22:
                    yield batch(rows)
                    rows, size = [], 0
            if held:
                rows.append((file, block, head, True, "".join(held)))
            if rows:
                yield batch(rows)

    return pieces.mapInArrow(run, _PART)


def array_objects(spark: SparkSession, path: str) -> DataFrame:
    """``(value)``: the text of each object of files that are one JSON array each.

    Elements that are no objects are left out. An empty file or array has none. A file cut off within an object
    leaves that object with one brace more, for the parser to take or refuse. An object has to fit in a row.
    """
    pieces = _pieces(spark, path)
    parts = _parts(pieces, _begins(pieces))
    crossing = F.col("head") | F.col("tail")
    # Parts of one element follow each other, at most one per split; one that is no head begins the next.
    order = Window.partitionBy("file").orderBy("block", F.desc("head"))
    joined = (
        parts.where(crossing)
        .withColumn("element", F.sum(F.when(F.col("head"), 0).otherwise(1)).over(order))
        .groupBy("file", "element").agg(F.sort_array(F.collect_list(F.struct("block", "value"))).alias("parts"))
        .select(F.array_join("parts.value", "").alias("value"))
    )
    return parts.where(~crossing).select("value").union(joined).where(F.startswith("value", F.lit("{")))


def read_array(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Records by a given schema from files that are one JSON array each."""
    return array_objects(spark, path).select(F.inline(F.array(F.from_json("value", ddl))))
