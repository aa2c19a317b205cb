"""Stateful dedup: a message is accepted unless its like was accepted less than a day apart.

The clock is the time of ingestion, so a replay accepts the same messages. Batches come in order of
arrival, rows of a batch in order of time. No row is dropped for its age: a late one is held against
the accepted times on both sides of its own. A refused repeat does not renew the block.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tessera.schema import DEDUP_SECONDS

# How long a topic holds messages, and so how late one can come.
RETENTION_SECONDS = 168 * 3600

# Groups of keys that share one call per batch; fixed for the life of a checkpoint.
BUCKETS = 4096

# Sweeps of a bucket in the time that an entry is kept.
SWEEPS = 8

# Parts of a bucket's state that are read and written as one; fixed for the life of a checkpoint.
PAGES = 256

_BUCKET = "__bucket"
_PAGE = "__page"
_AT = "__at"


def _page(name: str | None) -> int:
    """The page of a key in its bucket; the bucket comes from another hash."""
    return 0 if pd.isna(name) else crc32(name.encode()) % PAGES


class _Moments:
    """The rows of a batch in order, without repeats of one moment. Rows come in chunks and in no order; chunks wait
    until they are as many rows as are held, so that each row is sorted a few times, however many chunks there are."""

    def __init__(self, key: str, ts: str, order: str):
        self._key, self._ts, self._order = key, ts, order
        self._waiting: list[pd.DataFrame] = []
        self.rows = pd.DataFrame()

    def add(self, chunk: pd.DataFrame) -> pd.DataFrame:
        """Take in a chunk, and return the repeats of one moment that were found."""
        self._waiting.append(chunk)
        return self.settle() if sum(map(len, self._waiting)) >= len(self.rows) else chunk[:0]

    def settle(self) -> pd.DataFrame:
        if not self._waiting:
            return self.rows[:0]
        fresh = pd.concat(self._waiting)
        self._waiting = []
        at = fresh[self._ts].astype("datetime64[us]").astype("int64")
        fresh = fresh.assign(**{_AT: at, _PAGE: [_page(name) for name in fresh[self._key].tolist()]})
        every = pd.concat([self.rows, fresh]) if len(self.rows) else fresh
        every = every.sort_values([_PAGE, self._key, _AT, self._order])
        again = every.duplicated([self._key, _AT])
        self.rows = every[~again]
        return every[again]


class TtlDedup(StatefulProcessor):
    """Per bucket, pages of keys with their accepted times in microseconds.

    A batch reads and writes the pages of its own keys, each once: a large batch makes no call per key, and a small one
    touches a ``PAGES``-th of its bucket per key. Entries more than ``keep_seconds`` behind the newest time of the bucket
    go in a sweep, once per ``keep_seconds / SWEEPS`` of new time.
    """

    def __init__(self, key: str, ts: str, order: str, ttl_seconds: int, keep_seconds: int, columns: list[str]):
        self._key, self._ts, self._order = key, ts, order
        self._ttl, self._keep = ttl_seconds * 1_000_000, keep_seconds * 1_000_000
        self._columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._accepted = handle.getMapState("accepted", "page BIGINT", "names ARRAY<STRING>, at ARRAY<ARRAY<BIGINT>>")
        self._swept = handle.getValueState("swept", "at BIGINT")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        moments = _Moments(self._key, self._ts, self._order)
        for chunk in rows:
            moments.add(chunk)
        moments.settle()
        accepted = moments.rows[self._taken(moments.rows)]
        if len(accepted):
            yield accepted[self._columns]

    def _taken(self, batch: pd.DataFrame) -> list[bool]:
        """Which rows of the batch, in its order, are accepted; the state learns of them."""
        if batch.empty:
            return []
        taken: list[bool] = []
        names = batch[self._key].astype(object).where(batch[self._key].notna(), None)
        rows = zip(batch[_PAGE].tolist(), names.tolist(), batch[_AT].tolist(), strict=True)
        for page, of_page in groupby(rows, itemgetter(0)):
            held, free = self._held(page), []
            for name, own in groupby(of_page, itemgetter(1)):
                fresh, after = self._fold(held.get(name, []), [at for _, _, at in own])
                free += fresh
                if any(fresh):
                    held[name] = after
            if any(free):
                self._accepted.updateValue((page,), ([*held], [*held.values()]))
            taken += free
        if any(taken):
            self._sweep(int(batch[_AT][taken].max()))
        return taken

    def _held(self, page: int) -> dict[str | None, list[int]]:
        found = self._accepted.getValue((page,))
        return {name: list(at) for name, at in zip(*found, strict=True)} if found else {}

    def _sweep(self, newest: int) -> None:
        held = self._swept.get()
        if held is None:
            self._swept.update((newest,))
        elif newest - held[0] > self._keep // SWEEPS:
            last = newest - self._keep
            pages = [page for (page,), (_, at) in self._accepted.iterator() if any(max(one) <= last for one in at)]
            for page in pages:
                left = {name: at for name, at in self._held(page).items() if max(at) > last}
                if left:
                    self._accepted.updateValue((page,), ([*left], [*left.values()]))
                else:
                    self._accepted.removeKey((page,))
            self._swept.update((newest,))

    def _fold(self, accepted: list[int], times: list[int]) -> tuple[list[bool], list[int]]:
        """Which of ``times`` are accepted, and all accepted times that still matter."""
        free = []
        for at in times:
            place = bisect_left(accepted, at)
            near = accepted[max(0, place - 1) : place + 1]
            free.append(all(abs(at - other) >= self._ttl for other in near))
            if free[-1]:
                accepted.insert(place, at)
        return free, [at for at in accepted if at > accepted[-1] - self._keep]

    def close(self) -> None:
        pass


class TtlOutcomes(TtlDedup):
    """As ``TtlDedup``, but every row comes out, with what became of it in the last column: ``stored``, ``repeat``, or
    what it came with, for rows that were refused before. Repeats come out without the columns of ``dropped``."""

    def __init__(self, *args, outcome: str, dropped: list[str]):
        super().__init__(*args)
        self._outcome, self._dropped = outcome, dropped

    def _with(self, rows: pd.DataFrame, outcome: str) -> pd.DataFrame:
        lean = rows if outcome != "repeat" else rows.assign(**{c: None for c in self._dropped})
        return lean.assign(**{self._outcome: outcome})[self._columns]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        moments = _Moments(self._key, self._ts, self._order)
        for chunk in rows:
            refused = chunk[self._outcome].notna()
            if refused.any():
                yield chunk[refused][self._columns]
            again = moments.add(chunk[~refused])
            if len(again):
                yield self._with(again, "repeat")
        again, batch = moments.settle(), moments.rows
        if len(again):
            yield self._with(again, "repeat")
        taken = pd.Series(self._taken(batch), index=batch.index, dtype=bool)
        for outcome, rows_of in (("stored", batch[taken]), ("repeat", batch[~taken])):
            if len(rows_of):
                yield self._with(rows_of, outcome)


def ttl_outcomes_stream(
    stream: DataFrame, key: str, ts: str, order: str, outcome: str, dropped: list[str],
    ttl_seconds: int = DEDUP_SECONDS, keep_seconds: int = RETENTION_SECONDS + DEDUP_SECONDS, buckets: int = BUCKETS,
) -> DataFrame:
    """All rows of a stream with their ``outcome`` (see ``TtlOutcomes``); rows that have one already pass by. They are
    dealt by their order, as they may all lack a key."""
    dealt = F.when(F.col(outcome).isNull(), F.xxhash64(key)).otherwise(F.xxhash64(order))
    return (
        stream.withColumn(_BUCKET, F.pmod(dealt, F.lit(buckets)))
        .groupBy(_BUCKET)
        .transformWithStateInPandas(
            TtlOutcomes(key, ts, order, ttl_seconds, keep_seconds, stream.columns, outcome=outcome, dropped=dropped),
            outputStructType=stream.schema,
            outputMode="Append",
            timeMode="None",
        )
    )


def ttl_dedup_stream(
    stream: DataFrame,
    key: str,
    ts: str,
    order: str,
    ttl_seconds: int = DEDUP_SECONDS,
    keep_seconds: int = RETENTION_SECONDS + DEDUP_SECONDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The accepted rows of a stream, by a text column ``key``. A message that comes more than
    ``keep_seconds`` behind another of its key is accepted, as what was near it is forgotten; that may
    store a message twice, but loses none. All columns go through Python: select only those needed."""
    return (
        stream.withColumn(_BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)))
        .groupBy(_BUCKET)
        .transformWithStateInPandas(
            TtlDedup(key, ts, order, ttl_seconds, keep_seconds, stream.columns),
            outputStructType=stream.schema,
            outputMode="Append",
            timeMode="None",
        )
    )
