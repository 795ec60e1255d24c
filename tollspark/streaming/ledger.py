"""Consumed-offset ledger: a visible record of progress. Recovery itself rests on the checkpoint."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F


def offset_ledger(batch: DataFrame, group: str, submit_time: str | None = None) -> DataFrame:
    """Next offset to read per topic and partition of a batch, as rows to upsert by (group_id, topic, partition)."""
    until = batch.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("until_offset"))
    out = until.select(F.lit(group).alias("group_id"), "topic", "partition", "until_offset")
    if submit_time is None:
        return out
    return out.select("*", F.lit(submit_time).alias("submit_time"),
                      F.unix_timestamp(F.lit(submit_time)).alias("submit_unix"))


def starting_offsets(ledger: DataFrame, group: str) -> str:
    """The `startingOffsets` text of a group. A ledger has one row per topic partition, so it is small by nature."""
    offsets: dict[str, dict[str, int]] = {}
    for row in ledger.where(F.col("group_id") == group).select("topic", "partition", "until_offset").toLocalIterator():
        offsets.setdefault(row["topic"], {})[str(row["partition"])] = row["until_offset"]
    return json.dumps(offsets, sort_keys=True)
