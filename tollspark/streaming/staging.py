"""Decode once, feed many: a staging stream writes decoded rows as files, and every result of a job reads those.

The file sink keeps its own log of finished batches, so a repeated batch leaves no second copy, and readers see whole batches
only. Rejects lie in a partition of their own. A result scans the columns it needs of the decoded rows instead of parsing
the messages again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tollspark.streaming.runs import _triggered

VALID = "valid"


def stage(decoded: DataFrame, path: str, checkpoint: str, trigger: str | None = "60 seconds") -> StreamingQuery:
    """Write a decoded stream (with its column `valid`) under `path`; the one query that reads the source."""
    writer = decoded.writeStream.format("parquet").outputMode("append").partitionBy(VALID)
    return _triggered(writer.option("path", path).option("checkpointLocation", checkpoint), trigger).start()


def _read(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def decoded_rows(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the valid rows under `path`; `schema` is that of the frame that was staged."""
    return _read(spark, path, schema, max_files_per_trigger).where(F.col(VALID)).drop(VALID)


def rejected_rows(spark: SparkSession, path: str, schema: StructType, value: str = "value") -> DataFrame:
    """Stream of the texts that could not be decoded; needs a decoder that keeps them."""
    return _read(spark, path, schema, None).where(~F.col(VALID)).select(value)
