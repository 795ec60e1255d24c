"""Upload timeliness, deal success and device health on event-time windows.

Each operator is one hash aggregate over flags, so its partial step shrinks every key, however busy, before the
shuffle. The gantry dimension is joined after the aggregate: one lookup per gantry and window instead of one per
record. All of them take a table or a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tollspark.functions import times
from tollspark.functions.measures import count_where, rate, ratio
from tollspark.functions.text import installed, not_special, status_ok_no_zero, status_ok_zero_code


def unique_dim(dim: DataFrame, key: str = "mjid", columns: tuple[str, ...] = ("roadid", "tollstation")) -> DataFrame:
    """One row per key; of several, the smallest. A repeated key would multiply what it is joined to."""
    slim = dim.select(key, *columns).where(F.col(key).isNotNull())
    first = F.min(F.struct(*columns)).alias("_d")
    return slim.groupBy(key).agg(first).select(key, *[F.col("_d").getField(c).alias(c) for c in columns])


def enrich(df: DataFrame, dim: DataFrame, on: str = "gantry_id", key: str = "mjid",
           columns: tuple[str, ...] = ("roadid", "tollstation"), unique: bool = False) -> DataFrame:
    """Left join with the gantry dimension. `unique=True` promises unique keys.

    There is no broadcast hint: a real gantry dimension is far below spark.sql.autoBroadcastJoinThreshold and is
    broadcast by size, a large one is shuffled.
    """
    side = dim.select(key, *columns) if unique else unique_dim(dim, key, columns)
    return df.join(side.withColumnRenamed(key, "_dim_key"), F.col(on) == F.col("_dim_key"), "left").drop("_dim_key")


def _labelled(grouped: DataFrame, keys: list[str], measures: list[str], run_time: str | None, hour: bool = False,
              extra: tuple[Column, ...] = ()) -> DataFrame:
    """Window as two columns plus its date (and hour) in the session zone."""
    start = F.col("window").getField("start")
    labels = [F.to_date(start).alias("statis_day")]
    if hour:
        labels.append(F.hour(start).alias("statis_hour"))
    if run_time is not None:
        labels.append(F.lit(run_time).alias("update_time"))
    return grouped.select(*keys, *extra, start.alias("window_start"),
                          F.col("window").getField("end").alias("window_end"), *measures, *labels)


def timeliness(df: DataFrame, keys: list[str], threshold: int = 900, inclusive: bool = True,
               window: Column | None = None, counted: str | None = None, event: str = "event_time",
               receive: str = "receive_time", lateness: Column | None = None,
               run_time: str | None = None) -> DataFrame:
    """Timely and delayed records, total and both rates per `keys` and window (default: local day).

    Timely means received within `threshold` seconds of the event, bound included or not. `counted` names the column
    whose NULLs are left out of the total. `lateness` replaces the two times where seconds are at hand.
    """
    late = lateness if lateness is not None else times.lateness_seconds(event, receive)
    staged = df.select(*keys, (window if window is not None else times.day_window(event)).alias("window"),
                       late.alias("_late"), *([counted] if counted and counted not in keys else []))
    timely = F.col("_late") <= threshold if inclusive else F.col("_late") < threshold
    grouped = staged.groupBy(*keys, "window").agg(
        count_where(timely).alias("timely_sum"),
        count_where(~timely).alias("delay_sum"),
        F.count(F.col(counted) if counted else F.lit(1)).alias("total_sum"),
    )
    rated = grouped.withColumn("timely_rate", rate(F.col("timely_sum"), F.col("total_sum"))) \
                   .withColumn("delay_rate", rate(F.col("delay_sum"), F.col("total_sum")))
    return _labelled(rated, keys, ["timely_sum", "delay_sum", "total_sum", "timely_rate", "delay_rate"], run_time)


def gantry_timeliness(df: DataFrame, dim: DataFrame, threshold: int = 900, run_time: str | None = None,
                      **options) -> DataFrame:
    """Timeliness of gantry charges or pictures per gantry and day (strictly below the threshold), with road and
    station."""
    per_gantry = timeliness(df, ["gantry_id"], threshold, inclusive=False, counted="gantry_id", run_time=run_time,
                            **options)
    return enrich(per_gantry, dim)


def lane_timeliness(df: DataFrame, keys: list[str], threshold: int = 900, run_time: str | None = None,
                    **options) -> DataFrame:
    """Timeliness of lane transactions per lane, station, sub-centre and day (threshold included)."""
    return timeliness(df, keys, threshold, inclusive=True, run_time=run_time, **options)


def deal_success(df: DataFrame, keys: list[str], window: Column | None = None, event: str = "event_time",
                 dim: DataFrame | None = None, run_time: str | None = None) -> DataFrame:
    """Success and failure of OBU (media 1) and CPC card (media 2) deals without special types, with rates."""
    staged = df.select(*keys, (window if window is not None else times.day_window(event)).alias("window"),
                       "media_type", "trade_result", not_special("special_type").alias("_plain"))
    plain = F.col("_plain")
    counts, rates, names = [], {}, []
    for label, media in (("obu", 1), ("cpc", 2)):
        here = plain & (F.col("media_type") == media)
        counts += [
            count_where(here & (F.col("trade_result") == 0)).alias(f"success_{label}_count"),
            count_where(here & (F.col("trade_result") == 1)).alias(f"fail_{label}_count"),
            count_where(here).alias(f"all_{label}_count"),
        ]
        whole = F.col(f"all_{label}_count")
        rates[f"{label}_success_rate"] = rate(F.col(f"success_{label}_count"), whole)
        rates[f"{label}_fail_rate"] = rate(F.col(f"fail_{label}_count"), whole)
        names += [f"success_{label}_count", f"fail_{label}_count", f"all_{label}_count",
                  f"{label}_success_rate", f"{label}_fail_rate"]
    grouped = staged.groupBy(*keys, "window").agg(*counts, count_where(plain).alias("all_count"))
    out = _labelled(grouped.withColumns(rates), keys, [*names, "all_count"], run_time)
    return out if dim is None else enrich(out, dim)


# --- heartbeats ----------------------------------------------------------------------------------------------------

def sub_center(column: str = "station_id") -> Column:
    """Sub-centre of a station or charge unit: the first 11 characters."""
    return F.substring(column, 1, 11).alias("sub_center")


def heartbeat_hourly(df: DataFrame, keys: list[str], counted: str | None = None, event: str = "event_time",
                     center_of: str | None = None, dim: DataFrame | None = None,
                     run_time: str | None = None) -> DataFrame:
    """Heartbeats per device and hour; `counted` leaves NULLs of that column out."""
    staged = df.select(*keys, times.hour_window(event).alias("window"),
                       *([counted] if counted and counted not in keys else []))
    grouped = staged.groupBy(*keys, "window").agg(F.count(F.col(counted) if counted else F.lit(1))
                                                  .alias("heartbeat_count"))
    extra = (sub_center(center_of),) if center_of else ()
    out = _labelled(grouped, keys, ["heartbeat_count"], run_time, hour=True, extra=extra)
    return out if dim is None else enrich(out, dim)


def heartbeat_hourly_first(df: DataFrame, keys: list[str], representative: str, event: str = "event_time",
                           run_time: str | None = None) -> DataFrame:
    """Hourly count with the sub-centre of one charge unit of the group: the smallest, where any would do.

    Counting per unit first keeps the pass over all records a hash aggregate; only its small result is reduced by
    the text minimum. Takes tables only.
    """
    per_unit = df.select(*keys, representative, times.hour_window(event).alias("window")) \
                 .groupBy(*keys, "window", representative).agg(F.count(F.lit(1)).alias("_n"))
    grouped = per_unit.groupBy(*keys, "window").agg(
        F.sum("_n").alias("heartbeat_count"), F.substring(F.min(representative), 1, 11).alias("sub_center"))
    return _labelled(grouped, [*keys, "sub_center"], ["heartbeat_count"], run_time, hour=True)


DEVICE_RULES = {"no_zero": status_ok_no_zero, "zero_code": status_ok_zero_code}


def _device_counts(devices: dict[str, str]) -> list[Column]:
    counts = []
    for status, rule in devices.items():
        ok = DEVICE_RULES[rule](status) & installed(status)
        counts += [count_where(ok).alias(f"_{status}_ok"), count_where(installed(status)).alias(f"_{status}_all")]
    return counts


def device_rate_daily(df: DataFrame, keys: list[str], devices: dict[str, str], event: str = "event_time",
                      window: Column | None = None, center_of: str | None = None, dim: DataFrame | None = None,
                      drop_null_status: bool = False, run_time: str | None = None) -> DataFrame:
    """Share of normal states per device and day; `devices` maps a status column to `no_zero` or `zero_code`.

    Not-installed devices are left out of the denominator. NULL states count nowhere, so dropping those rows first
    only removes groups that have nothing else.
    """
    if drop_null_status:
        df = df.dropna(subset=list(devices))
    staged = df.select(*keys, (window if window is not None else times.day_window(event)).alias("window"), *devices)
    grouped = staged.groupBy(*keys, "window").agg(*_device_counts(devices))
    rated = grouped.withColumns({f"{s}_rate": rate(F.col(f"_{s}_ok"), F.col(f"_{s}_all")) for s in devices})
    extra = (sub_center(center_of),) if center_of else ()
    out = _labelled(rated, keys, [f"{s}_rate" for s in devices], run_time, extra=extra)
    return out if dim is None else enrich(out, dim)


def device_rate_by_subcenter(df: DataFrame, unit: str, devices: dict[str, str], key: str = "gantry_id",
                             **options) -> DataFrame:
    """Daily device rates per gantry and sub-centre of its charge unit."""
    return device_rate_daily(df.withColumn("sub_center", sub_center(unit)), [key, "sub_center"], devices, **options)


def healthy_devices(df: DataFrame, keys: list[str], devices: dict[str, str], threshold: float = 0.8,
                    event: str = "event_time", window: Column | None = None) -> DataFrame:
    """Devices and days whose rates, before rounding, all reach `threshold`."""
    staged = df.select(*keys, (window if window is not None else times.day_window(event)).alias("window"), *devices)
    grouped = staged.groupBy(*keys, "window").agg(*_device_counts(devices))
    exact = grouped.withColumns({f"{s}_rate": ratio(F.col(f"_{s}_ok"), F.col(f"_{s}_all")) for s in devices})
    for status in devices:
        exact = exact.where(F.col(f"{status}_rate") >= threshold)
    return _labelled(exact, keys, [f"{s}_rate" for s in devices], None)


def rate_sum_by_station(rates: DataFrame, station: str = "station_id", column: str = "rsu_status_rate") -> DataFrame:
    """Sum of the daily rates of a station's devices, for a batch of rate rows."""
    return rates.groupBy(station).agg(F.sum(column).alias("rate_sum"))


def rate_sums_by_window(df: DataFrame, keys: list[str], station: str, devices: dict[str, str], event: str = "event_time",
                        column: str = "rsu_status_rate") -> DataFrame:
    """`rate_sum_by_station` per day inside the stream: the daily rates of `keys` and `station`, and over them, in the same
    query, their sum per station and day. Two stateful aggregates in a row need append mode: a day follows when the
    watermark has closed it. Table or stream."""
    staged = df.select(*keys, station, times.day_window(event).alias("window"), *devices)
    counted = staged.groupBy(*keys, station, "window").agg(*_device_counts(devices))
    rated = counted.select(station, "window", rate(F.col(f"_{column[:-5]}_ok"), F.col(f"_{column[:-5]}_all")).alias("_rate"))
    summed = rated.groupBy(station, F.window(F.window_time("window"), "24 hours", "24 hours", "16 hours").alias("window")).agg(
        F.sum("_rate").alias("rate_sum"), F.count(F.lit(1)).alias("devices"))
    return summed.select(station, F.col("window.start").alias("window_start"), "rate_sum", "devices")


def health_changes(df: DataFrame, keys: list[str], devices: dict[str, str], threshold: float = 0.8,
                   event: str = "event_time") -> DataFrame:
    """`healthy_devices` for update mode: every device and day whose counts have changed, with its rates and `gone`, true
    where a rate is below the threshold or unknown. A HAVING would only add rows; upserted with `deleted="gone"`, a device
    that falls below leaves the table, and comes back when it recovers."""
    staged = df.select(*keys, times.day_window(event).alias("window"), *devices)
    grouped = staged.groupBy(*keys, "window").agg(*_device_counts(devices))
    exact = grouped.withColumns({f"{s}_rate": ratio(F.col(f"_{s}_ok"), F.col(f"_{s}_all")) for s in devices})
    healthy = F.lit(True)
    for status in devices:
        healthy = healthy & F.coalesce(F.col(f"{status}_rate") >= threshold, F.lit(False))
    return _labelled(exact.withColumn("gone", ~healthy), keys, [*[f"{s}_rate" for s in devices], "gone"], None)
