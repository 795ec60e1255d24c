"""Small helpers that several operators of this subpackage use."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tollspark.session import shared_folder

#: A word of the contracts that split on ASCII white space.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
_SLICE = 1024  # rows
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to a folder that every executor reads, and read it back: work done once, with no lineage behind it."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(-1))


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def batches_with(batches: Iterator[pa.RecordBatch], keep: list[str], make, rows: int = _SLICE) -> Iterator[pa.RecordBatch]:
    """Pass the columns `keep` through and add those that `make(batch)` returns as {name: arrow array}. Batches come in
    slices, so that few whole texts are Python objects at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            part = batch.slice(begin, rows)
            made = make(part)
            columns = [part.column(part.schema.get_field_index(name)) for name in keep] + list(made.values())
            yield pa.RecordBatch.from_arrays(columns, names=keep + list(made))


def bounded(df: DataFrame, rows: int) -> bool:
    """Whether a written table has `rows` rows at most: the check before a broadcast."""
    return df.count() <= rows


def widened(df: DataFrame, keep: list[str], added: str) -> StructType:
    """Schema of the columns `keep` of `df`, followed by the columns `added` (DDL)."""
    return StructType([df.schema[name] for name in keep] + StructType.fromDDL(added).fields)
