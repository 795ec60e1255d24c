"""Registered queries: every operator over the adapter views of the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tollspark.functions import measures, rowkey, text, times
from tollspark.operators import match, rates, reports, summary
from tollspark.plans import messages, views
from tollspark.session import shared_folder, state_partitions
from tollspark.sinks import tables as sinks
from tollspark.sources import decode as decoding, records, tables as sources, wide
from tollspark.streaming import join as stream_join, late, ledger, runs, staging, stateful

Query = Callable[[SparkSession, str], DataFrame]

RUN_TIME = "2024-02-01 00:00:00"
COLLECT_DAY = "2024-02-01"
TOLERANCE = 14400
MATCH = dict(on=["gantry_id", "plate"], lt="trans_unix", rt="pic_unix", tolerance=TOLERANCE)
LANE_DEVICES = {"rsu_status": "no_zero", "vplr_status": "no_zero", "lane_controller_status": "no_zero"}
GANTRY_DEVICES = {"rsu_status": "no_zero", "vplr_status": "zero_code"}
PAGE_VIEW_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("eventTime", "eventType", "userID")]).json()
STAGES = ("view", "click", "purchase", "signup", "error")

_REGISTRY: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Times as text and decimals as doubles, so that two engines can be compared value by value."""
    columns = []
    for field in df.schema.fields:
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DateType):
            column = column.cast("string")
        elif isinstance(kind, T.DecimalType):
            column = column.cast("double")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn(spark, sf_dir))

    _REGISTRY[fn.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- timeliness and deal success -----------------------------------------------------------------------------------

def _gantry_timeliness(df: DataFrame, dim: DataFrame, threshold: int) -> DataFrame:
    return rates.gantry_timeliness(df, dim, threshold, RUN_TIME, event="event_ts", lateness=F.col("delay_s"))


@query
def gantry_timeliness_daily(spark, sf_dir):
    return _gantry_timeliness(views.view(spark, sf_dir, "v_gantry"), views.view(spark, sf_dir, "v_dim"), 900)


@query
def picture_timeliness_daily(spark, sf_dir):
    return _gantry_timeliness(views.view(spark, sf_dir, "v_gantry"), views.view(spark, sf_dir, "v_dim"), 600)


def _lane_timeliness(df: DataFrame, keys: list[str]) -> DataFrame:
    times_of = df.withColumns({"event_time": F.timestamp_seconds("event_unix"),
                               "receive_time": F.timestamp_seconds("receive_unix")})
    return rates.lane_timeliness(times_of, keys, 900, RUN_TIME)


@query
def exit_lane_timeliness(spark, sf_dir):
    return _lane_timeliness(views.view(spark, sf_dir, "v_gantry"), ["lane_id", "station_id", "sub_center"])


@query
def entrance_lane_timeliness(spark, sf_dir):
    return _lane_timeliness(views.view(spark, sf_dir, "v_gantry"), ["lane_id", "gantry_id", "sub_center"])


@query
def lateness_classes(spark, sf_dir):
    seen = views.view(spark, sf_dir, "v_gantry").select(
        times.lateness_class(F.timestamp_seconds("event_unix"), F.timestamp_seconds("receive_unix"), 900)
        .alias("lateness"))
    return seen.groupBy("lateness").agg(F.count(F.lit(1)).alias("n"))


@query
def deal_success_rate(spark, sf_dir):
    return rates.deal_success(views.view(spark, sf_dir, "v_gantry"), ["gantry_id"], event="event_ts",
                              dim=views.view(spark, sf_dir, "v_dim"), run_time=RUN_TIME)


# --- heartbeats ----------------------------------------------------------------------------------------------------

def _lane_hourly(df: DataFrame) -> DataFrame:
    return rates.heartbeat_hourly(df, ["lane_id", "station_id"], event="event_ts", center_of="station_id",
                                  run_time=RUN_TIME)


def _gantry_hourly(df: DataFrame, dim: DataFrame) -> DataFrame:
    return rates.heartbeat_hourly(df, ["gantry_id"], "gantry_id", event="event_ts", dim=dim, run_time=RUN_TIME)


def _lane_daily(df: DataFrame) -> DataFrame:
    return rates.device_rate_daily(df, ["lane_id", "station_id"], LANE_DEVICES, event="event_ts",
                                   center_of="station_id", run_time=RUN_TIME)


def _gantry_daily(df: DataFrame, dim: DataFrame) -> DataFrame:
    return rates.device_rate_daily(text.drop_sentinel(df, "gantry_id"), ["gantry_id"], GANTRY_DEVICES,
                                   event="event_ts", dim=dim, run_time=RUN_TIME)


@query
def lane_heartbeat_hourly(spark, sf_dir):
    return _lane_hourly(views.view(spark, sf_dir, "v_heartbeat"))


@query
def gantry_heartbeat_hourly(spark, sf_dir):
    return _gantry_hourly(views.view(spark, sf_dir, "v_heartbeat"), views.view(spark, sf_dir, "v_dim"))


@query
def lane_device_rate_daily(spark, sf_dir):
    return _lane_daily(views.view(spark, sf_dir, "v_heartbeat"))


@query
def gantry_device_rate_daily(spark, sf_dir):
    return _gantry_daily(views.view(spark, sf_dir, "v_heartbeat"), views.view(spark, sf_dir, "v_dim"))


@query
def heartbeat_hourly_rep(spark, sf_dir):
    return rates.heartbeat_hourly_first(views.view(spark, sf_dir, "v_heartbeat"), ["gantry_id"], "charge_unit_id",
                                        event="event_ts")


@query
def device_rate_subcenter(spark, sf_dir):
    return rates.device_rate_by_subcenter(views.view(spark, sf_dir, "v_heartbeat"), "charge_unit_id",
                                          {"rsu_status": "no_zero", "vplr_status": "no_zero"}, event="event_ts")


@query
def healthy_devices(spark, sf_dir):
    devices = {"rsu_status": "no_zero", "lane_controller_status": "no_zero"}
    return rates.healthy_devices(views.view(spark, sf_dir, "v_heartbeat"), ["lane_id", "station_id"], devices,
                                 event="event_ts")


@query
def healthy_on_three_rates(spark, sf_dir):
    return rates.healthy_devices(views.view(spark, sf_dir, "v_heartbeat"), ["lane_id", "station_id"], LANE_DEVICES,
                                 event="event_ts")


@query
def rate_sum_by_station(spark, sf_dir):
    return rates.rate_sum_by_station(_lane_daily(views.view(spark, sf_dir, "v_heartbeat")))


# --- interval match ------------------------------------------------------------------------------------------------

def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return views.view(spark, sf_dir, "v_etc"), views.view(spark, sf_dir, "v_viu")


def _match_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = match.interval_match(*_sides(spark, sf_dir), **MATCH, collect="pic_id")
    return match.match_rows(found, RUN_TIME)


@query
def interval_match(spark, sf_dir):
    return _match_rows(spark, sf_dir)


@query
def interval_match_bucketed(spark, sf_dir):
    found = match.bucketed_interval_match(*_sides(spark, sf_dir), **MATCH, collect="pic_id", bucket=TOLERANCE)
    return match.match_rows(found, RUN_TIME)


@query
def interval_match_hot(spark, sf_dir):
    """The grid at work: every slice with more than two rows on a side counts as hot."""
    found = match.bucketed_interval_match(*_sides(spark, sf_dir), **MATCH, collect="pic_id", bucket=TOLERANCE,
                                          hot_rows=2)
    return match.match_rows(found, RUN_TIME)


@query
def interval_match_repeated(spark, sf_dir):
    """Every fifth picture was sent twice: joined once, listed as often as sent; in the grid as well."""
    etc, viu = _sides(spark, sf_dir)
    sent = viu.unionAll(viu.where("pic_unix % 5 = 0"))
    plain_, cut = (match.match_rows(found, RUN_TIME) for found in (
        match.interval_match(etc, sent, **MATCH, collect="pic_id", repeated_right=True),
        match.bucketed_interval_match(etc, sent, **MATCH, collect="pic_id", bucket=TOLERANCE, hot_rows=2)))
    return plain_.select(F.lit("plain").alias("way"), "*").unionAll(cut.select(F.lit("grid"), "*"))


@query
def interval_pairs(spark, sf_dir):
    return match.interval_pairs(*_sides(spark, sf_dir), **MATCH)


@query
def matched(spark, sf_dir):
    return match.matched(*_sides(spark, sf_dir), **MATCH)


@query
def unmatched(spark, sf_dir):
    return match.unmatched(*_sides(spark, sf_dir), **MATCH)


@query
def fuzzy_interval_match(spark, sf_dir):
    etc, viu = _sides(spark, sf_dir)
    found = match.fuzzy_interval_match(etc, viu.withColumnRenamed("plate", "pic_plate"), ["gantry_id"], "trans_unix",
                                       "pic_unix", TOLERANCE, "pic_id", "plate", "pic_plate", max_distance=1)
    return found.select(*etc.columns, F.array_join("matches", "/").alias("pic_ids"),
                        F.array_join("plates", "/").alias("pic_plates"), "sign", "degree")


@query
def match_summary(spark, sf_dir):
    return summary.match_summary(_match_rows(spark, sf_dir))


@query
def match_success_failure(spark, sf_dir):
    good, bad = match.split_matches(_match_rows(spark, sf_dir))
    shown = ["rowkey", "pic_ids", "plate", "pic_plate"]
    return good.select(F.lit("success").alias("outcome"), *shown).unionAll(
        bad.select(F.lit("failure").alias("outcome"), *shown))


@query
def row_keys(spark, sf_dir):
    etc = views.view(spark, sf_dir, "v_etc")
    return etc.select("trade_id", rowkey.row_key("trade_id", 100).alias("rowkey"),
                      rowkey.row_key("plate", 1000, "x").alias("plate_key"))


@query
def row_key_table(spark, sf_dir):
    path = shared_folder(spark, "row-key-table")
    good, _ = match.split_matches(_match_rows(spark, sf_dir))
    sinks.write_by_row_key(good, path)
    return spark.read.parquet(path)


# --- reports -------------------------------------------------------------------------------------------------------

def _exit_daily(spark: SparkSession, sf_dir: str, view: str = "v_exit") -> DataFrame:
    report = reports.exit_station_daily(views.view(spark, sf_dir, view), F.lit(COLLECT_DAY), F.col("event_day"), wide=True)
    return report.withColumn("eventDay", F.col("eventDay").cast("string"))


@query
def exit_station_daily(spark, sf_dir):
    return _exit_daily(spark, sf_dir)


@query
def exit_station_10min(spark, sf_dir):
    return reports.exit_station_period(views.view(spark, sf_dir, "v_exit_evt"), event="event_ts", legacy_label=True)


@query
def exit_station_10s(spark, sf_dir):
    return reports.exit_station_period(views.view(spark, sf_dir, "v_exit_evt"), "10 seconds", event="event_ts")


@query
def exit_station_wide(spark, sf_dir):
    """Every 97th order paid a thousandfold, so that amounts of a million and more are summed as well."""
    return _exit_daily(spark, sf_dir, "v_exit_large")


@query
def entrance_station_10min(spark, sf_dir):
    return reports.entrance_station_period(views.view(spark, sf_dir, "v_exit_evt"), event="event_ts")


@query
def entrance_station_10s(spark, sf_dir):
    return reports.entrance_station_period(views.view(spark, sf_dir, "v_exit_evt"), "10 seconds", event="event_ts")


def _issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.issue_flow_daily(views.view(spark, sf_dir, "v_issue"), F.lit(COLLECT_DAY),
                                    F.col("event_day").cast("string"))


@query
def issue_flow_daily(spark, sf_dir):
    return _issues(spark, sf_dir)


@query
def issue_flow_collected(spark, sf_dir):
    """Collection days from partition columns: cards are collected the day after the event."""
    issues = views.view(spark, sf_dir, "v_issue")
    day = F.date_add("event_day", 1)
    parts = issues.select("*", *[F.date_format(day, fmt).alias(name)
                                 for name, fmt in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))])
    return reports.issue_flow_daily(parts, reports.collect_day_of(), F.col("event_day").cast("string"))


@query
def overwrite_partitions(spark, sf_dir):
    path = shared_folder(spark, "issue-flow")
    sinks.overwrite_partitions(_issues(spark, sf_dir), path, ["collectDay", "eventDay"])
    back = spark.read.schema("pos_id string, chargeCardNum bigint, storeCardNum bigint, obuNum bigint, "
                             "collectDay string, eventDay string").parquet(path)
    return back


# --- counts --------------------------------------------------------------------------------------------------------

@query
def count_by_window(spark, sf_dir):
    return summary.count_by(views.view(spark, sf_dir, "v_exit_evt"), ["station_id", "station_name"], "1 day", "event_ts")


@query
def sliding_count(spark, sf_dir):
    return summary.sliding_count(views.ev(spark, sf_dir), ["event_type"], "25 minutes", "10 minutes", "event_ts")


@query
def token_count(spark, sf_dir):
    return summary.token_count(views.table(spark, sf_dir, "documents"), "text", " ")


@query
def distinct_lanes(spark, sf_dir):
    return summary.distinct_lanes(views.view(spark, sf_dir, "v_heartbeat"), ["station_id", "lane_id", "rsu_status"])


@query
def count_variants(spark, sf_dir):
    gantry = views.view(spark, sf_dir, "v_gantry")
    return gantry.groupBy("gantry_id").agg(F.count(F.lit(1)).alias("n_one"), F.count("*").alias("n_rows"),
                                           F.count("special_type").alias("n_special"))


@query
def latest_by_key(spark, sf_dir):
    rows = views.ev(spark, sf_dir).select("user_id", "event_ts", "event_id", "event_type", "value")
    return summary.latest_by_key(rows, ["user_id"], ["event_ts", "event_id"])


# --- decoding ------------------------------------------------------------------------------------------------------

def _gantry_json(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Gantry charges of the events, a table or a stream, as JSON messages of one topic."""
    rows = views.over("v_gantry", views.table(spark, sf_dir, "events") if events is None else events)
    message = F.to_json(F.struct(
        F.col("trade_id").alias("tradeId"), F.col("gantry_id").alias("gantryId"),
        F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("stationDBTime"),
        F.date_format(F.timestamp_seconds("receive_unix"), "yyyy-MM-dd HH:mm:ss.SSS").alias("receiveTime"),
        F.col("media_type").alias("mediaType"), F.col("trade_result").alias("tradeResult"),
        F.col("special_type").alias("specialType")))
    return rows.select(F.lit("gantry").alias("topic"), message.alias("value"), "trade_id", "media_type")


@query
def decode_events(spark, sf_dir):
    messages = sources.split_by_topic(_gantry_json(spark, sf_dir), "gantry").select("value")
    good, _ = decoding.split_valid(decoding.decode(messages, records.GANTRY))
    return good.select("trade_id", "gantry_id", "event_time", "receive_time", "media_type", "trade_result",
                       "special_type")


def _dealt(rows: DataFrame, per_slot: int = 3) -> DataFrame:
    """Narrow rows from which wide work follows, dealt to all slots: a small file of many rows would be read by few tasks."""
    parts = per_slot * rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= parts else rows.repartition(parts)


def _decoded(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Every message of the record at full width, with its columns where it is valid and its length where it is not."""
    record = wide.ALL[name]
    events = _dealt(views.table(spark, sf_dir, "events"))
    found = wide.decode(messages.messages(events, name), record, keep_raw=True)

    def shown(column: str, kind: str) -> Column:
        value = F.col(column)
        if kind.startswith("array"):  # gantry=state of every device
            value = F.array_join(F.transform(value, lambda d: F.concat_ws("=", d["gantryId"], F.coalesce(
                d[kind.split(",")[1].split(":")[0].strip()], F.lit("")))), ";")
        return F.when(F.col("valid"), value).alias(column)

    return found.select("event_id", *[shown(column, kind) for _, column, kind in record.fields()], shown("event_time", ""),
                        shown("receive_time", ""), F.length("value").alias("rejected_chars"))


@query
def decode_exit(spark, sf_dir):
    return _decoded(spark, sf_dir, "exit")


@query
def decode_entrance(spark, sf_dir):
    return _decoded(spark, sf_dir, "entrance")


@query
def decode_gantry(spark, sf_dir):
    return _decoded(spark, sf_dir, "gantry")


@query
def decode_picture(spark, sf_dir):
    return _decoded(spark, sf_dir, "picture")


@query
def decode_lane_heartbeat(spark, sf_dir):
    return _decoded(spark, sf_dir, "lane_heartbeat")


@query
def decode_gantry_heartbeat(spark, sf_dir):
    return _decoded(spark, sf_dir, "gantry_heartbeat")


@query
def reject_events(spark, sf_dir):
    """Errors of media 9 arrive cut off, those of media 3 with an impossible time; all others are fine."""
    whole = F.col("value")
    spoiled = F.when(F.col("media_type") == 9, F.substring(whole, 1, 20)) \
               .when(F.col("media_type") == 3, F.regexp_replace(whole, '"stationDBTime":"[0-9]{4}', '"stationDBTime":"x'))
    messages = _gantry_json(spark, sf_dir).select(F.coalesce(spoiled, whole).alias("value"), "media_type")
    _, rejects = decoding.split_valid(decoding.decode(messages.withColumnRenamed("media_type", "kind"),
                                                      records.GANTRY, keep_raw=True))
    return rejects.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("value")).alias("longest"))


def _page_views(spark: SparkSession, base: DataFrame) -> DataFrame:
    rows = spark.sql(views.EV_SPARK, src=base)
    shown = F.when(F.col("event_type") != "error", F.col("event_type"))
    return rows.select(F.to_json(F.struct(
        F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss").alias("eventTime"), shown.alias("eventType"),
        F.col("user_id").cast("string").alias("userID"))).alias("value"))


@query
def decode_schema_json(spark, sf_dir):
    messages = _page_views(spark, views.table(spark, sf_dir, "events"))
    flat = decoding.decode_with_schema_json(messages, PAGE_VIEW_SCHEMA)
    return flat.groupBy("eventType", "userID").agg(F.count(F.lit(1)).alias("n"), F.max("eventTime").alias("last_time"))


@query
def event_time_id(spark, sf_dir):
    ids = views.ev(spark, sf_dir).select(
        "event_id", F.concat(F.lit("G00703601300601010030"), F.date_format("event_ts", "yyyyMMddHHmmss"),
                             F.col("user_id").cast("string")).alias("id"))
    return ids.select("event_id", times.event_time_from_id("id").alias("event_time"))


@query
def event_time_version(spark, sf_dir):
    versions = views.ev(spark, sf_dir).select("event_id", F.date_format("event_ts", "yyyyMMddHHmm").alias("version"))
    return versions.select("event_id", times.event_time_from_version("version").alias("event_time"))


@query
def event_time_raw(spark, sf_dir):
    raw = views.ev(spark, sf_dir).select("event_id", F.to_json(F.struct(
        "event_type", F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("exTime"), "user_id")).alias("value"))
    return raw.select("event_id", times.event_time_from_raw("value", "exTime").alias("event_time"))


def _heartbeat_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.view(spark, sf_dir, "v_heartbeat")
    rsu = F.array(F.struct(F.col("gantry_id").alias("gantryId"), F.col("rsu_status").alias("RSUStatus")),
                  F.struct(F.col("gantry_id").alias("gantryId"), F.col("vplr_status").alias("RSUStatus")))
    camera = F.array(F.struct(F.col("gantry_id").alias("gantryId"), F.col("vplr_status").alias("statusCode")))
    return rows.select("hb_id", F.to_json(F.struct(
        F.col("charge_unit_id").alias("chargeUnitId"), rsu.alias("RSUHeartbeatList"),
        camera.alias("cameraHeartbeatList"), F.date_format("event_ts", "yyyyMMddHHmm").alias("heatVersion"))).alias("value"))


@query
def heartbeat_regex(spark, sf_dir):
    return _heartbeat_json(spark, sf_dir).select(
        "hb_id", text.find_first("value", "gantryId").alias("gantry_id"),
        F.array_join(text.find_all("value", "RSUStatus"), ",").alias("rsu_all"),
        text.count_members("value", "gantryId").alias("gantries"),
        text.find_count_equal("value", "RSUStatus", "21").alias("rsu_21"))


@query
def heartbeat_devices(spark, sf_dir):
    """Heartbeats decoded and unfolded to one row per device."""
    beats = decoding.decode(_heartbeat_json(spark, sf_dir), records.GANTRY_HEARTBEAT, keep_raw=True)
    devices = records.device_rows(beats)
    return devices.groupBy("charge_unit_id", "kind", "status").agg(F.count(F.lit(1)).alias("n"))


@query
def time_zone_parse(spark, sf_dir):
    local = views.ev(spark, sf_dir).select("event_id", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss").alias("local"))
    return local.select("event_id", F.unix_seconds(times.parse_zoned("local")).alias("unix_s"))


@query
def epoch_times(spark, sf_dir):
    return views.ev(spark, sf_dir).select("event_id", times.epoch_ms("event_ts").alias("ms"),
                                          times.epoch_s("event_ts").alias("s"))


@query
def blank_or_zero(spark, sf_dir):
    rows = views.view(spark, sf_dir, "v_gantry")
    cpc = F.when(F.col("media_type") == 2, F.col("delay_s"))
    return rows.select("trade_id", text.or_blank("special_type").alias("special"), text.or_zero(cpc).alias("cpc_delay"))


@query
def match_sides(spark, sf_dir):
    """Charges and pictures as messages bring them, with their times as text, in the shape that the match takes."""
    etc, viu = _sides(spark, sf_dir)

    def iso(seconds: str) -> Column:
        return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss")

    left = sources.etc_view(etc.select("trade_id", "plate", "gantry_id", iso("trans_unix").alias("trans_time")))
    right = sources.viu_view(viu.select("pic_id", "plate", "gantry_id", iso("pic_unix").alias("pic_time")))
    return left.toDF("id", "plate", "gantry_id", "at", "unix").unionAll(right.toDF("id", "plate", "gantry_id", "at", "unix"))


@query
def period_label(spark, sf_dir):
    start = times.period_start("event_ts")
    return views.ev(spark, sf_dir).groupBy(start.alias("start")).agg(F.count(F.lit(1)).alias("n")).select(
        times.period_label("start").alias("label"), times.period_label("start", legacy=True).alias("legacy_label"), "n")


# --- sources and sinks that write and read back --------------------------------------------------------------------

def _ods(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    path = shared_folder(spark, "ods")
    rows = views.ev(spark, sf_dir).select("event_id", "event_type", *[
        F.date_format("event_ts", fmt).alias(name)
        for name, fmt in (("hour", "HH"), ("year", "yyyy"), ("month", "MM"), ("day", "dd"))])
    sinks.overwrite_partitions(rows, path, columns)
    return spark.read.schema("event_id bigint, event_type string, hour string, year string, month string, day string") \
                .parquet(path)


@query
def scan_partition_day(spark, sf_dir):
    ods = _ods(spark, sf_dir, ["year", "month", "day"])
    day = sources.scan_partition(spark, ods, "2024", "01", "15")
    return day.groupBy("hour", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query
def scan_partition_hour(spark, sf_dir):
    ods = _ods(spark, sf_dir, ["year", "month", "day", "hour"])
    hour = sources.scan_partition(spark, ods, "2024", "01", "15", "07")
    return hour.groupBy("hour", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query
def dimension_scan(spark, sf_dir):
    """The dimension with more columns than are read; those that the suppliers lack are null."""
    path = shared_folder(spark, "dim")
    dim = views.view(spark, sf_dir, "v_dim")
    missing = [F.lit(None).cast("string").alias(c) for c in records.DIMENSION_COLUMNS if c not in dim.columns]
    dim.select("*", *missing, F.lit("x").alias("unread")).write.parquet(path)
    return sources.read_dim(spark, path).select("mjid", "roadid", "tollstation", "stationname")


@query
def line_stream(spark, sf_dir):
    """Text lines as a stream, counted as they come."""
    path = shared_folder(spark, "lines")
    views.table(spark, sf_dir, "events").select(F.concat_ws(" ", "event_type", "user_id").alias("value")) \
        .write.text(path)
    counts = summary.token_count(sources.read_lines(spark, path), "value", " ")
    return _replay(counts, ["value"])


@query
def plate_log(spark, sf_dir):
    path = shared_folder(spark, "plate-log")
    etc = views.view(spark, sf_dir, "v_etc")
    line = F.concat_ws(",", F.lpad("trade_id", 19, "G"), "plate",
                       F.date_format(F.timestamp_seconds("trans_unix"), "yyyy-MM-dd'T'HH:mm:ss"))
    etc.select(line.alias("value")).write.text(path)
    return sources.read_plate_log(spark, path)


@query
def append_json(spark, sf_dir):
    path = shared_folder(spark, "append-json")
    rows = views.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    sinks.append_json(rows, path, 5)
    return spark.read.schema(rows.schema).json(path)


@query
def kafka_values(spark, sf_dir):
    rows = views.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return sinks.to_kafka_value(rows, F.col("user_id"))


@query
def offset_ledger(spark, sf_dir):
    consumed = views.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"))
    return ledger.offset_ledger(consumed, "toll", RUN_TIME)


@query
def upsert_latest(spark, sf_dir):
    """One batch per event type: later types replace what earlier ones said of a user; types that are not listed come last,
    in one batch and by name."""
    target = sinks.BucketUpsert(shared_folder(spark, "upsert"), ["user_id"], buckets=8, order=["kind"])
    events = views.table(spark, sf_dir, "events").withColumnRenamed("event_type", "kind")
    counted = events.groupBy("user_id", "kind").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event"))
    place = F.array_position(F.array(*map(F.lit, STAGES)), F.col("kind"))
    staged = shared_folder(spark, "upsert-batches")
    counted.withColumn("stage", F.when(place > 0, place).otherwise(len(STAGES) + 1)).write.partitionBy("stage").parquet(staged)
    batches = spark.read.parquet(staged)
    for stage in range(1, len(STAGES) + 2):
        target.write(batches.where(F.col("stage") == stage).drop("stage"), stage)
    return target.read(spark)


@query
def overwrite_table(spark, sf_dir):
    """Issue reports as a partitioned catalog table, read by name: the days that a table of days names, without the first of
    the month, whose partition is pruned."""
    name = f"issue_flow_{uuid.uuid4().hex}"
    table = sinks.overwrite(_issues(spark, sf_dir), name, ["eventDay"])
    days = views.ev(spark, sf_dir).where("event_type = 'purchase' and k % 10 = 3").select(
        F.date_format("event_ts", "yyyy-MM-dd").alias("day")).distinct()
    return table.join(days, F.col("eventDay") == F.col("day")).where("eventDay <> '2024-01-01'").drop("day")


# --- streams -------------------------------------------------------------------------------------------------------

def _time_slices(events: DataFrame, slices: int) -> list[DataFrame]:
    """The events in slices of time, in order."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(seconds), F.max(seconds)).first()
    if first is None:
        return [events]
    at = F.least(F.floor((seconds - first) * slices / (last - first + 1)), F.lit(slices - 1))
    return [events.where(F.coalesce(at, F.lit(0)) == i) for i in range(slices)]


def _events_stream(spark: SparkSession, sf_dir: str, slices: int = 3, order: list[int] | None = None) -> DataFrame:
    """The events as they come in: in slices of time, of which a micro-batch takes one at most. The file source takes files by
    their age, so slices are written one after another, in `order`."""
    folder, events = shared_folder(spark, "events"), views.table(spark, sf_dir, "events")
    parts, files = _time_slices(events, slices), events.rdd.getNumPartitions()
    for i in order or range(len(parts)):
        if i < len(parts):  # the same number of files for each slice
            (parts[i].repartition(files) if files > 1 else parts[i]).write.mode("append").parquet(folder)
    return sources.stream_table(spark, folder, events.schema, max_files_per_trigger=files)


def _view_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return runs.with_lateness(views.over(name, _events_stream(spark, sf_dir)), "event_ts")


def _replayed(spark: SparkSession, jobs: list[tuple[DataFrame, list[str]]], mode: str = "update") -> list[DataFrame]:
    """Run streams over everything there is and return what their keyed tables then hold."""
    started = []
    for df, keys in jobs:
        target = sinks.Upsert(shared_folder(spark, "stream-table"), keys)
        started.append((df, target, shared_folder(spark, "stream-checkpoint")))
    with runs.started_with(spark, state_partitions(spark)):
        begun = runs.start_all(started, trigger=None, mode=mode)
    runs.await_all(begun)
    return [target.read(spark) for _, target, _ in started]


def _replay(df: DataFrame, keys: list[str], mode: str = "update") -> DataFrame:
    return _replayed(df.sparkSession, [(df, keys)], mode)[0]


@query
def stream_gantry_timeliness(spark, sf_dir):
    out = _gantry_timeliness(_view_stream(spark, sf_dir, "v_gantry"), views.view(spark, sf_dir, "v_dim"), 900)
    return _replay(out, ["gantry_id", "window_start"])


@query
def stream_picture_timeliness(spark, sf_dir):
    out = _gantry_timeliness(_view_stream(spark, sf_dir, "v_gantry"), views.view(spark, sf_dir, "v_dim"), 600)
    return _replay(out, ["gantry_id", "window_start"])


@query
def stream_gantry_staged(spark, sf_dir):
    """Timeliness and deal success of gantry charges, both from messages that one staging stream has decoded."""
    folder, checkpoint = shared_folder(spark, "decoded"), shared_folder(spark, "stream-checkpoint")
    decoded = wide.decode(_gantry_json(spark, sf_dir, _events_stream(spark, sf_dir)).select("value"), wide.GANTRY)
    staging.stage(decoded, folder, checkpoint, trigger=None).awaitTermination()
    rows = runs.with_lateness(staging.decoded_rows(spark, folder, decoded.schema), "event_time")
    keys = ["gantry_id", "window_start"]
    timely, deals = _replayed(spark, [
        (rates.gantry_timeliness(rows, views.view(spark, sf_dir, "v_dim"), 900, RUN_TIME), keys),
        (rates.deal_success(rows, ["gantry_id"], run_time=RUN_TIME), keys)])
    return timely.join(deals.drop("window_end", "statis_day", "update_time"), keys)


def _lane_stream(spark: SparkSession, sf_dir: str, keys: list[str]) -> DataFrame:
    stream = _view_stream(spark, sf_dir, "v_gantry")
    out = rates.lane_timeliness(stream, keys, 900, RUN_TIME, event="event_ts", lateness=F.col("delay_s"))
    return _replay(out, [*keys, "window_start"])


@query
def stream_exit_lane_timeliness(spark, sf_dir):
    return _lane_stream(spark, sf_dir, ["lane_id", "station_id", "sub_center"])


@query
def stream_entrance_lane_timeliness(spark, sf_dir):
    return _lane_stream(spark, sf_dir, ["lane_id", "gantry_id", "sub_center"])


@query
def stream_deal_success(spark, sf_dir):
    out = rates.deal_success(_view_stream(spark, sf_dir, "v_gantry"), ["gantry_id"], event="event_ts",
                             dim=views.view(spark, sf_dir, "v_dim"), run_time=RUN_TIME)
    return _replay(out, ["gantry_id", "window_start"])


def _lane_heartbeats(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Both lane heartbeat streams over one source, started together."""
    stream = _view_stream(spark, sf_dir, "v_heartbeat")
    keys = ["lane_id", "station_id", "window_start"]
    return _replayed(spark, [(_lane_hourly(stream), keys), (_lane_daily(stream), keys)])


@query
def stream_lane_heartbeat_hourly(spark, sf_dir):
    return _lane_heartbeats(spark, sf_dir)[0]


@query
def stream_lane_device_rate(spark, sf_dir):
    return _lane_heartbeats(spark, sf_dir)[1]


@query
def stream_gantry_heartbeat_hourly(spark, sf_dir):
    out = _gantry_hourly(_view_stream(spark, sf_dir, "v_heartbeat"), views.view(spark, sf_dir, "v_dim"))
    return _replay(out, ["gantry_id", "window_start"])


@query
def stream_gantry_device_rate(spark, sf_dir):
    out = _gantry_daily(_view_stream(spark, sf_dir, "v_heartbeat"), views.view(spark, sf_dir, "v_dim"))
    return _replay(out, ["gantry_id", "window_start"])


@query
def stream_rate_sum(spark, sf_dir):
    """Daily device rates summed up by station and day, both aggregates in one stream: a day's rates pass on when the
    watermark has closed the day, so both append. A closing heartbeat ten days later closes all days but its own."""
    source, path, checkpoint = (shared_folder(spark, name) for name in ("rate-events", "rate-sum", "rate-checkpoint"))
    out = None
    for part in _event_slices(spark, sf_dir):
        part.write.mode("append").parquet(source)
        if out is None:
            beats = views.over("v_heartbeat", sources.stream_table(spark, source, part.schema))
            out = rates.rate_sums_by_window(runs.with_lateness(beats, "event_ts"), ["lane_id"], "station_id", LANE_DEVICES,
                                            event="event_ts")
        with runs.rocksdb_state(spark), runs.started_with(spark, state_partitions(spark)):
            runs.passthrough(out, path, checkpoint).awaitTermination()
    return spark.read.schema(out.schema).parquet(path)


@query
def stream_healthy_devices(spark, sf_dir):
    """Devices healthy on all three rates, kept up to date: one that falls below the threshold leaves the table again."""
    out = rates.health_changes(_view_stream(spark, sf_dir, "v_heartbeat"), ["lane_id", "station_id"], LANE_DEVICES,
                               event="event_ts")
    target = sinks.BucketUpsert(shared_folder(spark, "healthy"), ["lane_id", "station_id", "window_start"], buckets=8,
                                deleted="gone")
    with runs.started_with(spark, state_partitions(spark)):
        runs.run_update(out, target, shared_folder(spark, "stream-checkpoint"), trigger=None).awaitTermination()
    return target.read(spark)


@query
def stream_late_rows(spark, sf_dir):
    """Lane heartbeats per day from three slices of which the second comes last: what is on time is counted, and rows whose day
    had closed by then are counted apart instead of vanishing."""
    beats = views.over("v_heartbeat", _events_stream(spark, sf_dir, slices=3, order=[0, 2, 1]))
    timed = beats.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    days = timed.select("lane_id", "event_ts", times.day_window("event_ts")["end"].alias("day"))
    marked = late.mark_late(days, "event_ts", "day", "1 day")
    path = shared_folder(spark, "late")
    with runs.rocksdb_state(spark), runs.started_with(spark, state_partitions(spark)):
        writer = marked.writeStream.format("parquet").partitionBy(late.LATE).outputMode("append")
        writer.option("path", path).option("checkpointLocation", shared_folder(spark, "stream-checkpoint")) \
            .trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(marked.schema).parquet(path)
    return rows.groupBy(late.LATE, F.date_format("day", "yyyy-MM-dd HH:mm:ss").alias("day_end")).agg(F.count("*").alias("n"))


@query
def stream_exit_station_10min(spark, sf_dir):
    out = reports.exit_station_period(_view_stream(spark, sf_dir, "v_exit_evt"), event="event_ts", legacy_label=True)
    return _replay(out, ["extollstationid", "statisticDay"])


@query
def stream_entrance_station_10min(spark, sf_dir):
    out = reports.entrance_station_period(_view_stream(spark, sf_dir, "v_exit_evt"), event="event_ts")
    return _replay(out, ["enTollStationId", "statisticDay"])


@query
def stream_count_by_window(spark, sf_dir):
    """Complete mode: every batch hands over the whole result."""
    out = summary.count_by(_view_stream(spark, sf_dir, "v_exit_evt"), ["station_id", "station_name"], "1 day", "event_ts")
    return _replay(out, ["station_id", "window_start"], mode="complete")


@query
def stream_token_count(spark, sf_dir):
    path = views.table_path(sf_dir, "documents")
    stream = sources.stream_table(spark, path, spark.read.parquet(path).schema)
    return _replay(summary.token_count(stream, "text", " "), ["value"])


@query
def stream_passthrough(spark, sf_dir):
    path = shared_folder(spark, "passthrough")
    stream = _events_stream(spark, sf_dir).select("event_id", "event_type", "props")
    runs.passthrough(stream, path, shared_folder(spark, "stream-checkpoint")).awaitTermination()
    return spark.read.parquet(path)


def _event_slices(spark: SparkSession, sf_dir: str, slices: int = 2) -> list[DataFrame]:
    """The events in slices of time, in order. The last slice also has a closing charge and picture of two users of their
    own, ten days later, which take the watermark of both sides past all others and stay in the state themselves."""
    events = views.table(spark, sf_dir, "events")
    parts = _time_slices(events, slices)
    both = events.agg((F.max("ts") + F.expr("interval 10 days")).alias("ts")).select(
        "ts", F.lit("0").alias("props"), F.inline(F.expr("array(named_struct('event_type', 'purchase', 'user_id', -1), "
                                                         "named_struct('event_type', 'view', 'user_id', -2))")))
    closing = both.select(*[(F.col(c) if c in both.columns else F.lit(None)).cast(events.schema[c].dataType).alias(c)
                            for c in events.columns])
    return [*parts[:-1], parts[-1].unionByName(closing)]


def _joined_stream(spark: SparkSession, sf_dir: str, label: str,
                   build: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """What `build` makes of the streams of charges and pictures, which arrive slice by slice, each slice in a run of its
    own from one checkpoint."""
    source, path, checkpoint = (shared_folder(spark, name) for name in (f"{label}-events", label, f"{label}-checkpoint"))
    out = None
    for part in _event_slices(spark, sf_dir):
        part.write.mode("append").parquet(source)
        if out is None:
            events = sources.stream_table(spark, source, part.schema)
            etc, viu = (views.over(name, events) for name in ("v_etc", "v_viu"))
            out = build(etc.withColumn("trans_time", F.timestamp_seconds("trans_unix")),
                        viu.withColumn("pic_time", F.timestamp_seconds("pic_unix")))
        with runs.rocksdb_state(spark), runs.started_with(spark, state_partitions(spark)):
            run = runs.passthrough(out, path, checkpoint)
        run.awaitTermination()
    return spark.read.schema(out.schema).parquet(path)


@query
def stream_interval_match(spark, sf_dir):
    """Pairs of charges and pictures, and the charges without picture, which follow once the watermark has passed them."""
    def build(etc: DataFrame, viu: DataFrame) -> DataFrame:
        return stream_join.stream_interval_match(etc, viu, MATCH["on"], "trans_time", "pic_time", TOLERANCE)

    return _joined_stream(spark, sf_dir, "stream-match", build) \
        .select("trade_id", "gantry_id", "plate", "trans_unix", "pic_id", "pic_unix")


def _left_joined(etc: DataFrame, viu: DataFrame) -> DataFrame:
    return stream_join.stream_left_join(etc, viu.drop("gantry_id"), ["plate"], "trans_time", "pic_time", within="4 hours")


@query
def stream_left_join(spark, sf_dir):
    """Pictures of the same plate within four hours, on the plate alone; charges without one follow as above."""
    return _joined_stream(spark, sf_dir, "stream-left-join", _left_joined).select("trade_id", "plate", "pic_id")


@query
def stream_left_join_count(spark, sf_dir):
    """Rows of the left join per day, counted in the same stream."""
    return _joined_stream(spark, sf_dir, "stream-join-count",
                          lambda etc, viu: stream_join.joined_count(_left_joined(etc, viu), "trans_time"))


@query
def running_count(spark, sf_dir):
    """Occurrences of each event type, with the idle timeout of 30 seconds; sessions that a pause ends are added up."""
    counts = stateful.running_count(_events_stream(spark, sf_dir), "event_type", sessions=True)
    return stateful.session_totals(_replay(counts, ["event_type", "session"]), ["event_type"], "n")


def _page_view_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _page_views(spark, _events_stream(spark, sf_dir))
    flat = decoding.decode_with_schema_json(messages, PAGE_VIEW_SCHEMA, required=[])
    return flat.withColumn("timestamp", times.parse_zoned("eventTime"))


@query
def pv_per_minute(spark, sf_dir):
    """Page views with the idle timeout of 10 seconds; sessions that a pause ends are added up."""
    counts = stateful.pv_per_minute(_page_view_stream(spark, sf_dir), sessions=True)
    return stateful.session_totals(_replay(counts, ["minute", "userID", "session"]), ["minute", "userID"], "pv")


@query
def pv_per_minute_windowed(spark, sf_dir):
    stream = runs.with_lateness(_page_view_stream(spark, sf_dir), "timestamp")
    return _replay(stateful.pv_per_minute_windowed(stream), ["minute", "userID"])
