"""Batch sinks and the keyed upsert."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tollspark.functions import rowkey
from tollspark.operators.summary import latest_by_key

BATCH = "batch_id"


def with_text_nulls(df: DataFrame) -> DataFrame:
    """Every value as text and NULL as the word `null`, the way the old result tables store them."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("null")).alias(c) for c in df.columns])


class _Folder:
    """Sub-folders of a table by batch id, in whatever store Spark reaches by the path."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.path, self._fs = path, self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def batches(self) -> dict[int, str]:
        """Finished batches: those whose writer left its success mark."""
        if not self._fs.exists(self._path(self.path)):
            return {}
        names = [entry.getPath().getName() for entry in self._fs.listStatus(self._path(self.path))]
        found = {int(name.split("=")[1]): f"{self.path}/{name}" for name in names if name.startswith(f"{BATCH}=")}
        return {i: path for i, path in sorted(found.items()) if self._fs.exists(self._path(f"{path}/_SUCCESS"))}

    def bytes(self, paths: list[str]) -> int:
        return sum(self._fs.getContentSummary(self._path(path)).getLength() for path in paths)

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


class Upsert:
    """Keyed replace-into of batches into a Parquet table; pass `write` to foreachBatch.

    Each batch is written beside the earlier ones under its batch id, so a batch costs what it holds and a repeated
    batch overwrites itself. `read` returns the newest row per key. Once there are `merge_after` batches that weigh no
    less than the last merge, `write` merges them with it, so over time a row is rewritten a bounded number of times and
    a read costs little more than the live rows. What a merge replaces is kept until the next one, for readers that are
    still at it. `compact` rewrites the live rows into a table elsewhere.
    Failures propagate, so a stream never moves past a batch it could not write. Batch ids come from the checkpoint:
    a stream that starts over with a new checkpoint needs a new table as well. One writer at a time.
    """

    def __init__(self, path: str, keys: list[str], legacy_nulls: bool = False, files: int | None = None,
                 order: list[str] | None = None, merge_after: int = 16):
        self.path, self.keys, self.legacy_nulls, self.files, self.order = path, keys, legacy_nulls, files, order
        self.merge_after = merge_after

    def write(self, batch: DataFrame, batch_id: int = 0) -> None:
        """`order` decides between rows of one batch with the same key, where a batch can hold several."""
        if self.order is not None:
            batch = latest_by_key(batch, self.keys, self.order)
        if self.legacy_nulls:
            batch = with_text_nulls(batch)
        if self.files is not None:
            batch = batch.repartition(self.files)  # coalesce would take the parallelism of the aggregate as well
        batch.write.mode("overwrite").parquet(f"{self.path}/part=new/{BATCH}={batch_id}")
        self._merge(batch.sparkSession)

    def _layout(self, spark: SparkSession) -> tuple[_Folder, _Folder, int, list[str], list[str]]:
        """Both folders, the batch of the last merge (-1 for none), its path in a list, and the paths of newer batches."""
        merged, new = _Folder(spark, f"{self.path}/part=merged"), _Folder(spark, f"{self.path}/part=new")
        bases = merged.batches()
        last = max(bases, default=-1)
        return merged, new, last, [bases[last]] if bases else [], [p for i, p in new.batches().items() if i > last]

    def _rows(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        return spark.read.option("basePath", self.path).parquet(*paths).drop("part")

    def _merge(self, spark: SparkSession) -> None:
        merged, new, last, base, fresh = self._layout(spark)
        if len(fresh) < self.merge_after or new.bytes(fresh) < merged.bytes(base):
            return
        newest = max(new.batches())
        rows = latest_by_key(self._rows(spark, base + fresh), self.keys, [BATCH]).drop(BATCH)
        rows.write.mode("overwrite").parquet(f"{merged.path}/{BATCH}={newest}")
        # The last merge and the batches after it stay for readers that began before this one.
        for folder, before in ((merged, last), (new, last + 1)):
            for batch_id, path in folder.batches().items():
                if batch_id < before:
                    folder.remove(path)

    def read(self, spark: SparkSession) -> DataFrame:
        *_, base, fresh = self._layout(spark)
        return latest_by_key(self._rows(spark, base + fresh), self.keys, [BATCH]).drop(BATCH)

    def compact(self, spark: SparkSession, path: str) -> Upsert:
        """The current rows as a new table that carries on after the last batch."""
        _, new, last, *_ = self._layout(spark)
        last = max([last, *new.batches()])
        fresh = Upsert(path, self.keys, False, self.files, merge_after=self.merge_after)
        fresh.write(self.read(spark), last)
        fresh.legacy_nulls, fresh.order = self.legacy_nulls, self.order
        return fresh


class BucketUpsert:
    """Keyed replace-into of batches, by bucket; pass `write` to foreachBatch.

    The table is partitioned by a hash of the keys. A batch rewrites the buckets that it has keys of, and no other, so what it
    costs grows with the buckets it touches and not with the table, and a read is a plain scan of one row per key. Rows keep
    the id of their batch: a repeated batch, or one whose commit was cut short between two buckets, comes to the same rows.
    `deleted` names a boolean column of the batches; rows with true in it hide their key until a later batch brings it back.
    `order` decides between rows of one batch with the same key. One writer at a time.
    """

    def __init__(self, path: str, keys: list[str], buckets: int = 64, order: list[str] | None = None,
                 deleted: str | None = None):
        self.path, self.keys, self.buckets, self.order, self.deleted = path, keys, buckets, order, deleted

    def _stored(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def write(self, batch: DataFrame, batch_id: int = 0) -> None:
        spark = batch.sparkSession
        if self.order is not None:
            batch = latest_by_key(batch, self.keys, self.order)
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")
        fresh = batch.select("*", F.lit(batch_id).cast("bigint").alias(BATCH), bucket).persist()
        touched = [row.bucket for row in fresh.select("bucket").distinct().collect()]  # `buckets` of them at most
        if touched:
            stored = self._stored(spark)
            if stored is not None:
                kept = stored.where(F.col("bucket").isin(touched)).select(*fresh.columns)
                merged = latest_by_key(kept.unionAll(fresh), self.keys, [BATCH])
            else:
                merged = fresh
            merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                  .partitionBy("bucket").parquet(self.path)
        fresh.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        rows = self._stored(spark)
        if rows is None:
            raise FileNotFoundError(f"nothing has been written to {self.path}")
        if self.deleted:
            rows = rows.where(~F.coalesce(F.col(self.deleted), F.lit(False))).drop(self.deleted)
        return rows.drop(BATCH, "bucket")


def upsert_batch(df: DataFrame, path: str, keys: list[str], batch_id: int, **options) -> Upsert:
    """Keyed replace-into of one batch table."""
    target = Upsert(path, keys, **options)
    target.write(df, batch_id)
    return target


def overwrite(df: DataFrame, table: str, partitions: list[str] | None = None) -> DataFrame:
    """Replace a catalog table, partitioned where columns are given, and return it as it is then read by its name."""
    writer = (df.hint("rebalance", *partitions) if partitions else df).write.mode("overwrite")
    (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(table)
    return df.sparkSession.read.table(table)


def overwrite_partitions(df: DataFrame, path: str, columns: list[str]) -> None:
    """Replace exactly the partitions `df` has rows for.

    Rebalancing brings the rows of a partition together, so that not every task writes into every partition, and lets
    Spark split a partition that has grown large and merge small ones.
    """
    df.hint("rebalance", *columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
      .partitionBy(*columns).parquet(path)


def with_row_key(df: DataFrame, key: str, buckets: int = 100, suffix: str = "") -> DataFrame:
    return df.withColumn("rowkey", rowkey.row_key(key, buckets, suffix))


def write_by_row_key(df: DataFrame, path: str, partitions: int | None = None,
                     columns: tuple[str, ...] = ("rowkey", "pic_ids", "run_time")) -> None:
    """Rows in row-key ranges, sorted within each, as a key-value store would load them."""
    slim = df.select(*columns)
    ranged = slim.repartitionByRange(partitions, "rowkey") if partitions else slim.repartitionByRange("rowkey")
    ranged.sortWithinPartitions("rowkey").write.mode("overwrite").parquet(path)


def append_json(df: DataFrame, path: str, files: int | None = None) -> None:
    """One file per partition, or `files` of them where the volume is known to be small."""
    (df if files is None else df.repartition(files)).write.mode("append").json(path)


def append_jdbc(df: DataFrame, url: str, table: str, **properties: str) -> None:
    df.write.jdbc(url, table, mode="append", properties=properties)


def to_kafka_value(df: DataFrame, key: Column | None = None) -> DataFrame:
    """Rows as JSON text in the `value` column a Kafka sink expects."""
    value = F.to_json(F.struct("*")).alias("value")
    return df.select(value) if key is None else df.select(key.cast("string").alias("key"), value)
