"""Shared pieces of the text operators: words, lines and bounded Arrow slices.

A word is a run of characters other than the six ASCII white space characters; on UTF-8 bytes
that is exactly what ``bytes.split()`` yields.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BREAK = r"[\x20\x09-\x0D]+"

#: A slice of a batch holds at most so much text, unless one text alone is longer.
SLICE_BYTES = 8 << 20


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_BREAK), "")


def hexed(value: Column) -> Column:
    """A long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def slices(
    batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with a bounded amount of text."""
    for batch in batches:
        start, held = 0, 0
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        for row, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is an empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def per_row(
    docs: DataFrame, keep: list[str], text: str, make: Callable[[bytes], tuple], schema: str
) -> DataFrame:
    """Columns of ``schema`` made from each text by ``make``, beside the columns of ``keep``.

    Runs in Arrow batches; a row is handled on its own, so any lost task can be run again.
    """
    narrow = docs.select(*keep, text)
    kept = ", ".join(f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in keep)
    made = [part.split()[0] for part in schema.split(",")]
    target = pa_schema(narrow, keep, schema)

    def run(batches):
        for batch in slices(batches, text):
            rows = [make(x) for x in as_bytes(batch.column(text))]
            columns = [batch.column(c) for c in keep]
            columns += [
                pa.array(values, type=target.field(c).type)
                for c, values in zip(made, zip(*rows), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *made])

    return narrow.mapInArrow(run, f"{kept}, {schema}" if keep else schema)


def pa_schema(narrow: DataFrame, keep: list[str], schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    made = StructType.fromDDL(schema)
    return pa.schema(
        [(c, to_arrow_type(narrow.schema[c].dataType)) for c in keep]
        + [(f.name, to_arrow_type(f.dataType)) for f in made.fields]
    )
