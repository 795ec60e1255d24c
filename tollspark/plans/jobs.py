"""Whole jobs from source to sink, composed of the operators.

Streaming jobs take any stream with `topic` and `value` text columns (`sources.read_kafka`, or files in a test) and
return started queries; what cannot be decoded goes to a reject table instead of being dropped.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tollspark.functions import text
from tollspark.operators import match, rates, reports, summary
from tollspark.session import shared_folder
from tollspark.sinks import tables as sinks
from tollspark.sources import decode as decoding, tables as sources
from tollspark.sources.records import (ENTRANCE, EXIT, GANTRY, GANTRY_HEARTBEAT, LANE_HEARTBEAT, PICTURE, Record)
from tollspark.streaming import runs, staging

LANE_DEVICES = {"rsu_status": "no_zero", "vplr_status": "no_zero", "lane_controller_status": "no_zero"}
GANTRY_DEVICES = {"rsu_status": "no_zero", "vplr_status": "zero_code"}


# --- batch ---------------------------------------------------------------------------------------------------------

def match_job(charges: DataFrame, pictures: DataFrame, out: str, run_time: str, tolerance: int, year: str, month: str,
              day: str, hour: str | None = None, granularity: str | None = None, buckets: int = 100,
              unique_left: bool = False) -> DataFrame:
    """Match one day or hour of charges to pictures and write `success`, `failure` and the row-key table under `out`.

    The result feeds three tables and the summary it returns, so it is written once in the shared folder and read
    back: losing an executor later costs a re-read, not a second match.
    """
    spark = charges.sparkSession
    sides = [sources.scan_partition(spark, t, year, month, day, hour, granularity) for t in (charges, pictures)]
    etc = sources.etc_view(sides[0]).drop("trans_time")
    viu = sources.viu_view(sides[1]).drop("pic_time")
    found = match.interval_match(etc, viu, ["gantry_id", "plate"], "trans_unix", "pic_unix", tolerance, "pic_id",
                                 unique_left=unique_left)
    staged = shared_folder(spark, "match")
    match.match_rows(found, run_time, buckets=buckets).write.parquet(staged)
    rows = spark.read.parquet(staged)
    good, bad = match.split_matches(rows)
    shown = ["rowkey", "pic_ids", "run_time", "plate", "pic_plate"]
    good.select(*shown).write.mode("overwrite").parquet(os.path.join(out, "success"))
    bad.select(*shown).write.mode("overwrite").parquet(os.path.join(out, "failure"))
    sinks.write_by_row_key(good, os.path.join(out, "by_row_key"))
    return summary.match_summary(rows)


def exit_daily_job(transactions: DataFrame, out: str, year: str, month: str, day: str, hour: str | None = None,
                   granularity: str | None = None, legacy: bool = False) -> None:
    """Daily exit-station report into a table partitioned by collection and event day."""
    day_rows = sources.scan_partition(transactions.sparkSession, transactions, year, month, day, hour, granularity)
    report = reports.exit_station_daily(day_rows, reports.collect_day_of(), F.substring("ex_time", 1, 10),
                                        legacy=legacy, wide=True)
    sinks.overwrite_partitions(report, out, ["collectDay", "eventDay"])


def issue_daily_job(issues: DataFrame, out: str, year: str, month: str, day: str, hour: str | None = None,
                    granularity: str | None = None) -> None:
    """Daily card-issuance report into a table partitioned by collection and event day."""
    day_rows = sources.scan_partition(issues.sparkSession, issues, year, month, day, hour, granularity)
    report = reports.issue_flow_daily(day_rows, reports.collect_day_of(), F.col("oper_time"))
    sinks.overwrite_partitions(report, out, ["collectDay", "eventDay"])


# --- streaming -----------------------------------------------------------------------------------------------------

def _run(messages: DataFrame, topic: str, record: Record, out: str, trigger: str | None, delay: str,
         results: dict[str, tuple[Callable[[DataFrame], DataFrame], list[str]]]) -> dict[str, StreamingQuery]:
    """Start the staging query, which decodes the messages once, then one query per result table and one for the rejects
    over what it writes, each with its own checkpoint under `out`. With no trigger each takes what is there and stops, so
    staging is awaited first."""
    spark = messages.sparkSession
    decoded = decoding.decode(sources.split_by_topic(messages, topic).select("value"), record, keep_raw=True)
    folder = os.path.join(out, "_decoded")
    started = {"decoded": staging.stage(decoded, folder, os.path.join(out, "_checkpoints", "decoded"), trigger)}
    if trigger is None:
        started["decoded"].awaitTermination()
    for name, (build, keys) in results.items():
        timed = runs.with_lateness(staging.decoded_rows(spark, folder, decoded.schema), "event_time", delay)
        target = sinks.Upsert(os.path.join(out, name), keys)
        started[name] = runs.run_update(build(timed), target, os.path.join(out, "_checkpoints", name), trigger)
    started["rejects"] = runs.passthrough(staging.rejected_rows(spark, folder, decoded.schema), os.path.join(out, "rejects"),
                                          os.path.join(out, "_checkpoints", "rejects"), trigger)
    return started


def gantry_job(messages: DataFrame, dim: DataFrame, topic: str, out: str, threshold: int = 900,
               trigger: str | None = "60 seconds", delay: str = "1 day", run_time: str | None = None):
    """Gantry charges: upload timeliness and deal success per gantry and day."""
    keys = ["gantry_id", "window_start"]
    return _run(messages, topic, GANTRY, out, trigger, delay, {
        "timeliness": (lambda df: rates.gantry_timeliness(df, dim, threshold, run_time), keys),
        "deal_success": (lambda df: rates.deal_success(df, ["gantry_id"], dim=dim, run_time=run_time), keys)})


def picture_job(messages: DataFrame, dim: DataFrame, topic: str, out: str, threshold: int = 900,
                trigger: str | None = "60 seconds", delay: str = "1 day", run_time: str | None = None):
    """Gantry pictures: upload timeliness per gantry and day."""
    return _run(messages, topic, PICTURE, out, trigger, delay, {
        "timeliness": (lambda df: rates.gantry_timeliness(df, dim, threshold, run_time), ["gantry_id", "window_start"])})


def lane_job(messages: DataFrame, topic: str, out: str, entrance: bool = False, threshold: int = 900,
             trigger: str | None = "60 seconds", delay: str = "1 day", run_time: str | None = None):
    """Lane transactions: upload timeliness per lane, station, sub-centre and day.

    Exit transactions, too, are grouped by the lane the vehicle entered through.
    """
    keys = ["entrance_lane_id", "station_id", "sub_center"]
    return _run(messages, topic, ENTRANCE if entrance else EXIT, out, trigger, delay, {
        "timeliness": (lambda df: rates.lane_timeliness(df, keys, threshold, run_time), [*keys, "window_start"])})


def lane_heartbeat_job(messages: DataFrame, topic: str, out: str, trigger: str | None = "60 seconds",
                       delay: str = "1 day", run_time: str | None = None):
    """Lane heartbeats: hourly counts and daily device rates."""
    keys = ["lane_id", "station_id"]
    return _run(messages, topic, LANE_HEARTBEAT, out, trigger, delay, {
        "hourly": (lambda df: rates.heartbeat_hourly(df, keys, center_of="station_id", run_time=run_time),
                   [*keys, "window_start"]),
        "daily": (lambda df: rates.device_rate_daily(df, keys, LANE_DEVICES, center_of="station_id", run_time=run_time),
                  [*keys, "window_start"])})


def gantry_heartbeat_job(messages: DataFrame, dim: DataFrame, topic: str, out: str, trigger: str | None = "60 seconds",
                         delay: str = "1 day", run_time: str | None = None):
    """Gantry heartbeats: hourly counts and daily device rates with road and station.

    A message naming no gantry counts under the no-data sentinel in the hourly table and nowhere in the daily one.
    """
    keys = ["gantry_id", "window_start"]

    def named(df: DataFrame) -> DataFrame:
        return df.withColumn("gantry_id", F.coalesce("gantry_id", F.lit(text.NO_DATA)))

    return _run(messages, topic, GANTRY_HEARTBEAT, out, trigger, delay, {
        "hourly": (lambda df: rates.heartbeat_hourly(named(df), ["gantry_id"], "gantry_id", dim=dim, run_time=run_time), keys),
        "daily": (lambda df: rates.device_rate_daily(text.drop_sentinel(df, "gantry_id"), ["gantry_id"], GANTRY_DEVICES,
                                                     dim=dim, run_time=run_time), keys)})


def station_job(messages: DataFrame, topic: str, out: str, entrance: bool = False, length: str = "10 minutes",
                trigger: str | None = "60 seconds", delay: str = "1 day", legacy_label: bool = False):
    """Exit or entrance station report per event-time period; state keeps the running totals of a period."""
    if entrance:
        build = lambda df: reports.entrance_station_period(df, length, legacy_label=legacy_label)
        keys = ["enTollStationId", "enTollStationName", "statisticDay"]
    else:
        build = lambda df: reports.exit_station_period(df, length, legacy_label=legacy_label, wide=True)
        keys = ["extollstationid", "exTollStationName", "statisticDay"]
    return _run(messages, topic, ENTRANCE if entrance else EXIT, out, trigger, delay, {"stations": (build, keys)})
