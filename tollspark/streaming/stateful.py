"""Keyed state with an idle timeout. `keyed_count` and what is made of it are the package's only Python operators.

Rows are counted per key inside each task before the shuffle, so what a busy key sends to its one state row is a partial
count per half a million rows and not its rows. Counts are kept by bucket of keys, with the time of each key's last row, in a
state list with a time to live: a key that stays away begins again, and a bucket that does is forgotten by the state store
itself. With `closing` a timer per bucket forgets keys instead, and reports the counts that are about to go, in the first
batch after their time. Between the processes and in the store the counts of a bucket travel as one Arrow record batch in a
binary column, since a row of its own costs each key many times what counting it does.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PACKED = T.StructType([T.StructField("_packed", T.BinaryType())])


def _pack(rows: list[tuple], schema: pa.Schema) -> bytes:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(column, field.type) for column, field in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema).serialize().to_pybytes()


def _unpack(packed: bytes, schema: pa.Schema) -> pa.RecordBatch:
    return pa.ipc.read_record_batch(pa.py_buffer(packed), schema)


def _plain(column: pa.Array) -> list:
    """`to_pylist`, for the usual keys and counts without a step per value."""
    if pa.types.is_string(column.type) or pa.types.is_integer(column.type) and not column.null_count:
        return column.to_numpy(zero_copy_only=False).tolist()
    return column.to_pylist()


def _rows(packed: bytes, schema: pa.Schema) -> Iterator[tuple]:
    return zip(*[_plain(column) for column in _unpack(packed, schema).columns], strict=True)


def _gathered(batches: Iterable[pa.RecordBatch], rows: int, size: int = 1 << 26) -> Iterator[pa.Table]:
    """Batches put together into tables of about `rows` rows, or of `size` bytes where that is less."""
    held, n, weight = [], 0, 0
    for batch in batches:
        held.append(batch)
        n, weight = n + batch.num_rows, weight + batch.nbytes
        if n >= rows or weight >= size:
            yield pa.Table.from_batches(held)
            held, n, weight = [], 0, 0
    if n:
        yield pa.Table.from_batches(held)


def _plain_key(field: T.StructField) -> Column:
    """A key as Arrow can group it: no two zeros, and NULL for NaN."""
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return F.nanvl(F.col(field.name), F.lit(None).cast(field.dataType)) + F.lit(0).cast(field.dataType)
    return F.col(field.name)


def _arrow(fields: Iterable[T.StructField], *longs: str) -> pa.Schema:
    return to_arrow_schema(T.StructType([*[T.StructField(f.name, f.dataType) for f in fields],
                                         *[T.StructField(n, T.LongType()) for n in longs]]))


def _partial_counts(df: DataFrame, fields: list[T.StructField], buckets: int, rows: int = 500_000) -> DataFrame:
    """`_bucket` and, packed, its keys with their counts in `_n`: one row per bucket and `rows` rows of a task."""
    schema = _arrow(fields, "_n")
    places = [str(i) for i in range(len(fields))]  # names that no result of Arrow's has

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches, rows):
            named = table.rename_columns([*places, "_bucket"])
            counts = named.group_by([*places, "_bucket"], use_threads=False).aggregate([([], "count_all")])
            counts = counts.sort_by("_bucket")
            bucket = counts["_bucket"].to_numpy()
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            pairs = counts.select([*places, "count_all"]).rename_columns(schema.names).cast(schema)
            whole = pairs.combine_chunks().to_batches()[0]
            packed = [whole.slice(at, n).serialize().to_pybytes()
                      for at, n in zip(starts, np.diff(starts, append=len(bucket)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[starts]), pa.array(packed, pa.binary())],
                                             names=["_bucket", "_packed"])

    keyed = df.select(*[_plain_key(f).alias(f.name) for f in fields])
    bucket = F.pmod(F.xxhash64(*keyed.columns), F.lit(buckets).cast("bigint")).alias("_bucket")
    return keyed.select("*", bucket).mapInArrow(count, T.StructType([T.StructField("_bucket", T.LongType()), *_PACKED]))


class IdleCounts(StatefulProcessor):
    """Adds up partial counts per key until the key has been idle for `timeout_ms` of processing time. A call gets all
    rows of a bucket of keys, and reads and writes the bucket's counts in one go: each look into the store is a message to
    another process."""

    def __init__(self, keys: T.StructType, names: list[str], timeout_ms: int, sessions: bool, closing: bool):
        self.keys, self.names, self.timeout_ms, self.sessions, self.closing = keys, names, timeout_ms, sessions, closing

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # With a timer the counts have to stay until a batch comes that can report them.
        self.held = handle.getListState("held", self._held_schema(), None if self.closing else self.timeout_ms)

    def _held_schema(self) -> T.StructType:
        return T.StructType([*self.keys.fields, *[T.StructField(n, T.LongType()) for n in ("_n", "_session", "_last")]])

    def _held_rows(self) -> Iterable[tuple]:
        return self.held.get()

    def _hold(self, rows: list[tuple]) -> None:
        self.held.put(rows)

    def _values(self, key: tuple, session: int, n: int, closed: bool) -> tuple:
        return (*key, *([session] if self.sessions else []), n, *([closed] if self.closing else []))

    def _row(self, key: tuple, session: int, n: int, closed: bool) -> Row:
        return Row(**dict(zip(self.names, self._values(key, session, n, closed), strict=True)))

    def _counts(self) -> dict[tuple, tuple[int, int, int]]:
        """(count, session, time of the last row) of each key of the bucket."""
        return {tuple(row[:-3]): tuple(row[-3:]) for row in self._held_rows()}

    def _keep(self, counts: dict[tuple, tuple[int, int, int]]) -> None:
        if counts:
            self._hold([(*key, *count) for key, count in counts.items()])
        else:
            self.held.clear()
        if self.closing:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if counts:
                self.handle.registerTimer(min(last for _, _, last in counts.values()) + self.timeout_ms)

    def _over(self, counts: dict[tuple, tuple[int, int, int]], now: int) -> list[tuple]:
        return [key for key, (_, _, last) in counts.items() if last + self.timeout_ms <= now]

    def _closed(self, counts: dict[tuple, tuple[int, int, int]], now: int) -> list[Row]:
        """The last rows of the keys that have timed out, which leave `counts`."""
        gone = [(key, *counts.pop(key)) for key in self._over(counts, now)] if self.closing else []
        return [self._row(key, session, n, True) for key, n, session, _ in gone]

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now, width = timerValues.getCurrentProcessingTimeInMs(), len(self.keys)
        counts, seen = self._counts(), {}
        if not self.closing:  # a key that was idle for too long begins again
            for gone in self._over(counts, now):
                del counts[gone]
        for row in rows:
            one = tuple(row[:width])
            seen[one] = seen.get(one, 0) + row[width]
        for one, n in seen.items():
            before, session, _ = counts.get(one, (0, now, now))
            counts[one] = (before + n, session, now)
        found = [self._row(one, counts[one][1], counts[one][0], False) for one in seen]
        found += self._closed(counts, now)
        self._keep(counts)
        yield from found

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        counts = self._counts()
        found = self._closed(counts, timerValues.getCurrentProcessingTimeInMs())
        self._keep(counts)
        yield from found

    def close(self) -> None:
        pass


class PackedIdleCounts(IdleCounts):
    """`IdleCounts` whose rows, held counts and results are packed, all of a bucket in one value."""

    def __init__(self, keys: T.StructType, out: T.StructType, timeout_ms: int, sessions: bool, closing: bool):
        super().__init__(keys, out.fieldNames(), timeout_ms, sessions, closing)
        self.given, self.kept, self.out = _arrow(keys, "_n"), _arrow(keys, "_n", "_session", "_last"), _arrow(out)

    def _held_schema(self) -> T.StructType:
        return _PACKED

    def _held_rows(self) -> Iterable[tuple]:
        return [row for held in self.held.get() for row in _rows(held[0], self.kept)]

    def _hold(self, rows: list[tuple]) -> None:
        self.held.put([(_pack(rows, self.kept),)])

    def _row(self, key: tuple, session: int, n: int, closed: bool) -> tuple:
        return self._values(key, session, n, closed)

    def _packed(self, found: Iterator[tuple]) -> Iterator[Row]:
        if rows := list(found):
            yield Row(_packed=_pack(rows, self.out))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        counted = (one for row in rows for one in _rows(row["_packed"], self.given))
        yield from self._packed(super().handleInputRows(key, counted, timerValues))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._packed(super().handleExpiredTimer(key, timerValues, expiredTimerInfo))


def keyed_count(df: DataFrame, keys: list[str], timeout_ms: int, name: str, sessions: bool = False,
                closing: bool = False, buckets: int = 4096) -> DataFrame:
    """Running count per key in update mode. A key idle for `timeout_ms` of processing time loses its state and
    starts again from zero.

    `sessions` adds the column `session`, the processing time in milliseconds at which the key's state began (a batch
    that is repeated has the same). Upsert by key and session then, and no stored count ever goes down: a key's total is
    the sum over its sessions, see `session_totals`. `closing` adds the column `closed` and a last row with true in it when a
    key times out. The state is kept in `buckets` of keys, by hash, and a batch rewrites the live counts of the buckets it has
    rows of; a checkpoint is bound to their number.
    """
    fields = [df.schema[k] for k in keys]
    names = ["session", name] if sessions else [name]
    out = T.StructType([*fields, *[T.StructField(n, T.LongType()) for n in names],
                        *([T.StructField("closed", T.BooleanType())] if closing else [])])
    schema = _arrow(out)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (_unpack(packed, schema) for batch in batches for packed in batch.column(0).to_pylist())
        for table in _gathered(found, 10_000):
            yield from table.combine_chunks().to_batches()

    state = PackedIdleCounts(T.StructType(fields), out, timeout_ms, sessions, closing)
    counts = _partial_counts(df, fields, buckets).groupBy("_bucket") \
        .transformWithState(state, _PACKED, "Update", "ProcessingTime")
    return counts.mapInArrow(unpack, out)


def session_totals(counts: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Totals per key over all sessions of a table of session counts."""
    return counts.groupBy(*keys).agg(F.sum(name).alias(name))


def running_count(df: DataFrame, key: str, timeout_seconds: int = 30, sessions: bool = False) -> DataFrame:
    """Running number of occurrences of each `key`."""
    return keyed_count(df, [key], timeout_seconds * 1000, "n", sessions)


def pv_per_minute(df: DataFrame, event: str = "timestamp", user: str = "userID", kind: str | None = "eventType",
                  timeout_seconds: int = 10, sessions: bool = False) -> DataFrame:
    """Page views per (minute, user); rows lacking time, user or event type are left out."""
    needed = [event, user, *([kind] if kind else [])]
    rows = df.dropna(subset=needed).select(F.date_format(event, "yyyy-MM-dd HH:mm").alias("minute"),
                                           F.col(user).cast("string").alias("userID"))
    return keyed_count(rows, ["minute", "userID"], timeout_seconds * 1000, "pv", sessions)


def pv_per_minute_windowed(df: DataFrame, event: str = "timestamp", user: str = "userID",
                           kind: str | None = "eventType") -> DataFrame:
    """`pv_per_minute` as a native count per event-time window: state goes with the watermark of `event`, if it has one,
    and no count ever starts again. Table or stream."""
    needed = [event, user, *([kind] if kind else [])]
    counts = df.dropna(subset=needed).groupBy(F.window(event, "1 minute").alias("window"),
                                              F.col(user).cast("string").alias("userID")).agg(F.count(F.lit(1)).alias("pv"))
    return counts.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("minute"), "userID", "pv")
