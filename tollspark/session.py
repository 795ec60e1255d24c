"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE re-plans joins and partition counts from real shuffle sizes, which is what keeps one busy gantry from
# setting the pace. ANSI stays on: bad casts are handled with try_cast where a NULL is wanted.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Python call sites in error messages cost a stack trace per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tollspark", master: str | None = None, zone: str = "UTC",
                  shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session. `zone` is the zone in which days and hours are labelled."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SQL_SETTINGS, "spark.sql.session.timeZone": zone}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**settings, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def state_partitions(spark: SparkSession) -> dict[str, str]:
    """Setting for streams to start with: on a local master no more state partitions than there are slots, each being
    a store of its own to open per batch. A cluster keeps its configured number, which fixes the state's layout."""
    name = "spark.sql.shuffle.partitions"
    chosen = int(spark.conf.get(name))
    if spark.sparkContext.master.startswith("local"):
        chosen = min(chosen, spark.sparkContext.defaultParallelism)
    return {name: str(chosen)}


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for written tables and stream checkpoints.

    It lies under `spark.checkpoint.dir`, which a cluster points at storage all executors see. Only a local master,
    where driver and executors share one disk, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="tollspark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")
