"""Starting streams: watermark, output mode, trigger, checkpoint and keyed sink."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tollspark.sinks.tables import Upsert

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def with_lateness(df: DataFrame, column: str = "event_time", delay: str = "1 day") -> DataFrame:
    """Watermark on an event time; a zone-less time is read in the session zone first."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


@contextmanager
def started_with(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for the streams started inside; a stream keeps those it was started with."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, off the heap; a day of windows need not fit in memory."""
    return started_with(spark, {_PROVIDER: ROCKSDB})


def _triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """`trigger` is an interval such as `60 seconds`; None takes what is there and stops."""
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)


def foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update",
                  trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """Hand every micro-batch to `fn` as a table.

    A run that takes what is there and stops has no use for batches without data, and with a processing-time timeout
    would never run out of them.
    """
    writer = _triggered(df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint), trigger)
    if name:
        writer = writer.queryName(name)
    settings = {_PROVIDER: ROCKSDB}
    if trigger is None and mode != "append":
        settings[_EMPTY_BATCHES] = "false"
    with started_with(df.sparkSession, settings):
        return writer.foreachBatch(fn).start()


def run_update(df: DataFrame, target: Upsert, checkpoint: str, trigger: str | None = "60 seconds",
               mode: str = "update", name: str | None = None) -> StreamingQuery:
    """Streaming query into a keyed table: changed rows (`update`) or all rows (`complete`) of each batch."""
    return foreach_batch(df, target.write, checkpoint, mode, trigger, name)


def start_all(runs: Iterable[tuple[DataFrame, Upsert, str]], trigger: str | None = "60 seconds",
              mode: str = "update") -> list[StreamingQuery]:
    """Several queries, usually over one source; each has its own (frame, target, checkpoint)."""
    return [run_update(df, target, checkpoint, trigger, mode) for df, target, checkpoint in runs]


def await_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        query.awaitTermination()


def write_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str,
                trigger: str | None = "1 second") -> StreamingQuery:
    """Append a stream with a `value` column to a topic."""
    writer = df.writeStream.format("kafka").outputMode("append").options(**kafka_sink_options(servers, topic,
                                                                                              checkpoint))
    return _triggered(writer, trigger).start()


def kafka_sink_options(servers: str, topic: str, checkpoint: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}


def passthrough(df: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                fmt: str = "parquet") -> StreamingQuery:
    """Append a stream unchanged to files."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    return _triggered(writer.option("path", path), trigger).start()
