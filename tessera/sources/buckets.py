"""Tables in hash buckets, with a manifest per version: a change rewrites the buckets it touches, and all other
files are shared by both versions.

``data/<table>/<write>/bucket=<b>`` holds the files of one bucket as one write left them. ``version=<n>`` holds a
manifest that names, per table and bucket, the folder that counts, and a marker that names the manifest. A version counts
once its marker is there, so a load that is cut off leaves the last one as it was, and one that is repeated writes
new folders and its marker again. The number of buckets follows the rows, so that a bucket stays small and what a
change costs follows the change; the driver holds one line per bucket, MOST_BUCKETS at most.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera import scratch

ROWS_PER_BUCKET = 1 << 18
LEAST_BUCKETS, MOST_BUCKETS = 1, 1 << 16

_MARKER = "_COMMITTED"
_BUCKET = "bucket"

#: From the stored rows of the touched buckets and the changes, the rows these buckets hold from now on.
Combine = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class Table:
    """A table of one version: per bucket its folder and rows. Empty buckets are left out."""

    keys: list[str]
    ddl: str
    buckets: int
    parts: dict[int, tuple[str, int]] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.parts.values())


@dataclass(frozen=True)
class Version:
    tables: dict[str, Table]
    #: What the writer wants to remember beside the tables.
    note: dict


def _path(spark: SparkSession, *parts: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join(parts))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _write_text(spark: SparkSession, text: str, *parts: str) -> None:
    fs, path = _path(spark, *parts)
    out = fs.create(path, True)
    out.write(bytearray(text.encode()))
    out.close()


def _read_text(spark: SparkSession, *parts: str) -> str:
    fs, path = _path(spark, *parts)
    source = fs.open(path)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def _children(spark: SparkSession, *parts: str) -> list[str]:
    fs, path = _path(spark, *parts)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def versions(spark: SparkSession, root: str) -> list[int]:
    """The versions that were written in full."""
    found = [int(n.split("=")[1]) for n in _children(spark, root) if n.startswith("version=")]
    return sorted(v for v in found if _exists(spark, root, f"version={v}", _MARKER))


def _exists(spark: SparkSession, *parts: str) -> bool:
    fs, path = _path(spark, *parts)
    return fs.exists(path)


def latest(spark: SparkSession, root: str, below: int | None = None) -> int | None:
    """The last version, or the last one below a number."""
    return max((v for v in versions(spark, root) if below is None or v < below), default=None)


def load(spark: SparkSession, root: str, version: int | None) -> Version:
    if version is None:
        return Version({}, {})
    name = _read_text(spark, root, f"version={version}", _MARKER)
    held = json.loads(_read_text(spark, root, f"version={version}", name))
    tables = {
        t: Table(d["keys"], d["ddl"], d["buckets"], {int(b): tuple(p) for b, p in d["parts"].items()})
        for t, d in held["tables"].items()
    }
    return Version(tables, held["note"])


def commit(spark: SparkSession, root: str, version: int, tables: dict[str, Table], note: dict | None = None) -> None:
    name = f"manifest-{uuid.uuid4().hex}.json"
    text = json.dumps({"tables": {t: asdict(d) for t, d in tables.items()}, "note": note or {}})
    _write_text(spark, text, root, f"version={version}", name)
    _write_text(spark, name, root, f"version={version}", _MARKER)


def pending(note: dict, batches: list[int]) -> list[int]:
    """The batches that a version does not have yet, by its note."""
    through, beyond = note.get("through", -1), set(note.get("beyond", []))
    return [b for b in batches if b > through and b not in beyond]


def noted(note: dict, taken: list[int]) -> dict:
    """The note with more batches: all up to one, and some beyond it."""
    through, beyond = note.get("through", -1), set(note.get("beyond", [])) | set(taken)
    while through + 1 in beyond:
        through += 1
    return {"through": through, "beyond": sorted(b for b in beyond if b > through)}


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read(spark: SparkSession, root: str, table: Table, only: set[int] | None = None) -> DataFrame:
    """All rows, or those of some buckets; no file of another bucket is opened."""
    paths = [f"{root}/{folder}" for b, (folder, _) in sorted(table.parts.items()) if only is None or b in only]
    if not paths:
        return spark.createDataFrame([], table.ddl)
    return spark.read.schema(table.ddl).parquet(*paths)


def touched(table: Table, keys: DataFrame) -> set[int]:
    """The buckets in which these keys are, if anywhere."""
    rows = keys.select(bucket_of(table.keys, table.buckets).alias("b")).distinct().collect()
    return {r["b"] for r in rows}


def lookup(spark: SparkSession, root: str, table: Table | None, keys: DataFrame, ddl: str) -> DataFrame:
    """The rows of the buckets in which these keys are; the keys are still to be joined."""
    if table is None:
        return spark.createDataFrame([], ddl)
    return read(spark, root, table, touched(table, keys))


def _wanted(rows: int) -> int:
    n = LEAST_BUCKETS
    while n < MOST_BUCKETS and n * ROWS_PER_BUCKET < rows:
        n *= 2
    return n


def _written(df: DataFrame, root: str, name: str, keys: list[str], ddl: str, buckets: int) -> dict[int, tuple[str, int]]:
    spark = df.sparkSession
    folder = f"data/{name}/{uuid.uuid4().hex}"
    (
        df.select(*_columns(ddl), bucket_of(keys, buckets).alias(_BUCKET)).hint("rebalance", _BUCKET)
        .write.partitionBy(_BUCKET).parquet(f"{root}/{folder}")
    )
    counts = spark.read.schema(f"{ddl}, {_BUCKET} INT").parquet(f"{root}/{folder}").groupBy(_BUCKET).agg(
        F.count(F.lit(1)).alias("n")
    )
    return {r[_BUCKET]: (f"{folder}/{_BUCKET}={r[_BUCKET]}", r["n"]) for r in counts.collect()}


def _columns(ddl: str) -> list[str]:
    return [f"`{c}`" for c in StructType.fromDDL(ddl).names]


def replaced(keys: list[str]) -> Combine:
    """A change takes the place of the stored row with the same keys."""

    def combine(stored: DataFrame, changes: DataFrame) -> DataFrame:
        return stored.join(changes.select(*keys), keys, "left_anti").unionByName(changes)

    return combine


def update(
    changes: DataFrame, root: str, name: str, keys: list[str], ddl: str, table: Table | None,
    combine: Combine | None = None,
) -> Table:
    """``table`` (None: an empty one) with the changes. ``changes`` should come from files, as it is read twice.

    Only touched buckets are read and written. A table that outgrew its buckets is written anew in more of them.
    """
    spark = changes.sparkSession
    combine = combine or replaced(keys)
    changes = changes.select(*_columns(ddl))
    if table is None or table.rows > 2 * ROWS_PER_BUCKET * table.buckets < 2 * ROWS_PER_BUCKET * MOST_BUCKETS:
        rows = (table.rows if table else 0) + changes.count()
        held = read(spark, root, table) if table else spark.createDataFrame([], ddl)
        n = _wanted(rows)
        return Table(keys, ddl, n, _written(combine(held, changes), root, name, keys, ddl, n))
    hit = touched(table, changes)
    if not hit:
        return table
    new = combine(read(spark, root, table, hit), changes)
    kept = {b: p for b, p in table.parts.items() if b not in hit}
    return Table(keys, ddl, table.buckets, kept | _written(new, root, name, keys, ddl, table.buckets))


def differing(rows: DataFrame, root: str, table: Table | None) -> DataFrame:
    """Of rows that could replace stored ones, those that are new or differ, written once."""
    if table is None:
        return scratch.materialise(rows, "changes")
    rows = scratch.materialise(rows.select(*_columns(table.ddl)), "incoming")
    stored = read(rows.sparkSession, root, table, touched(table, rows))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in _columns(table.ddl)]
    condition = same[0]
    for one in same[1:]:
        condition &= one
    return scratch.materialise(rows.alias("a").join(stored.alias("b"), condition, "left_anti"), "changes")


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove the versions before the last ``keep`` and the folders that no version left needs, and return how many
    folders went. Not to be run beside a load."""
    kept = versions(spark, root)[-keep:]
    needed = {
        folder.rsplit("/", 1)[0]
        for v in kept for t in load(spark, root, v).tables.values() for folder, _ in t.parts.values()
    }
    gone = 0
    for table in _children(spark, root, "data"):
        for write in _children(spark, root, "data", table):
            if f"data/{table}/{write}" not in needed:
                scratch.drop(spark, f"{root}/data/{table}/{write}")
                gone += 1
    for name in _children(spark, root):
        if name.startswith("version=") and kept and int(name.split("=")[1]) < kept[0]:
            scratch.drop(spark, f"{root}/{name}")
    return gone
