"""Batch and streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tollspark.functions import times
from tollspark.sources.records import DIMENSION_COLUMNS, PLATE_LOG_SCHEMA


def read_kafka(spark: SparkSession, servers: str, topics: str | list[str], starting: str = "latest",
               max_per_trigger: int | None = None, fail_on_data_loss: bool = True, **options: str) -> DataFrame:
    """Stream of (topic, partition, offset, value text) from one or several topics.

    Offsets that have expired stop the stream unless `fail_on_data_loss` is off.

    `starting` is `earliest`, `latest` or the JSON that `starting_offsets` builds; it only matters for a query
    without a checkpoint.
    """
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topics, starting, max_per_trigger,
                                                                      fail_on_data_loss))
    return kafka_text(reader.options(**options).load())


def kafka_options(servers: str, topics: str | list[str], starting: str = "latest",
                  max_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    chosen = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger is not None:
        chosen["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return chosen


def kafka_text(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("topic").cast("string").alias("topic"), "partition", "offset",
                           F.col("value").cast("string").alias("value"))


def split_by_topic(messages: DataFrame, topic: str) -> DataFrame:
    return messages.where(F.col("topic") == topic)


def stream_table(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """Replay a Parquet table, a folder or a single file, as a stream.

    The path goes in as a pattern that matches only itself, because a plain path has to be a folder.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def read_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of text lines (`value`) from a folder."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def scan_partition(spark: SparkSession, table: str | DataFrame, year: str, month: str, day: str,
                   hour: str | None = None, granularity: str | None = None) -> DataFrame:
    """Rows of one day, or of one hour of it if `hour` is given, from a table partitioned by text year/month/day/hour.
    `granularity` (`day` or `hour`) may say so as well, but not otherwise."""
    if granularity is not None and granularity != ("day" if hour is None else "hour"):
        raise ValueError(f"granularity {granularity} with hour {hour}")
    frame = spark.read.table(table) if isinstance(table, str) else table
    chosen = (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day)
    if hour is not None:
        chosen = chosen & (F.col("hour") == hour)
    return frame.where(chosen)


def read_dim(spark: SparkSession, path: str) -> DataFrame:
    """Gantry dimension (gantry, station, road) from Parquet."""
    return spark.read.parquet(path).select(*DIMENSION_COLUMNS)


def read_plate_log(spark: SparkSession, path: str) -> DataFrame:
    """Headerless `id,plate_colour,time` log; the first 19 characters of a transaction id are its gantry."""
    log = spark.read.schema(PLATE_LOG_SCHEMA).csv(path, encoding="UTF-8")
    return log.select("id", "plate", times.parse_iso("time").alias("time"),
                      F.substring("id", 1, 19).alias("gantry_id"))


def etc_view(charges: DataFrame) -> DataFrame:
    """Gantry charges as the left side of the plate match."""
    when = times.parse_iso("trans_time")
    return charges.select("trade_id", "plate", "gantry_id", when.alias("trans_time"),
                          times.epoch_s(when).alias("trans_unix"))


def viu_view(pictures: DataFrame) -> DataFrame:
    """Gantry pictures as the right side of the plate match."""
    when = times.parse_iso("pic_time")
    return pictures.select("pic_id", "plate", "gantry_id", when.alias("pic_time"),
                           times.epoch_s(when).alias("pic_unix"))
