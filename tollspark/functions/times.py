"""Event times, windows and period labels. Everything stays a built-in column expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


# --- reading times -------------------------------------------------------------------------------------------------

def parse_iso(column: Column | str) -> Column:
    """`2020-05-13T23:00:14` or the same with a blank, to timestamp; NULL when unreadable."""
    return F.try_to_timestamp(_col(column))


def event_time_from_id(column: Column | str, start: int = 22, fmt: str = "yyyyMMddHHmmss") -> Column:
    """Time embedded in a record id: 14 digits from the 22nd character."""
    return F.try_to_timestamp(F.substring(_col(column), start, len(fmt)), F.lit(fmt))


def event_time_from_version(column: Column | str) -> Column:
    """Time from a 12-digit heartbeat version, `yyyyMMddHHmm`, seconds zero."""
    return F.try_to_timestamp(_col(column), F.lit("yyyyMMddHHmm"))


def event_time_from_raw(column: Column | str, field: str) -> Column:
    """Time found in raw JSON text as `"field":"2020-05-13T23:00:14"` without decoding the record."""
    day, clock = r"[0-9]{4}(?:-[0-9]{2}){2}", "[0-9]{2}(?::[0-9]{2}){2}"
    pattern = rf'"{field}"\s*:\s*"({day}T{clock})"'
    return F.try_to_timestamp(F.regexp_extract(_col(column), pattern, 1))


def parse_zoned(column: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss", zone: str = "GMT+8",
                session_zone: Column | None = None) -> Column:
    """Wall-clock text of `zone` to an instant, whatever the session zone; NULL when unreadable."""
    wall_clock = F.try_to_timestamp(_col(column), F.lit(fmt)).cast("timestamp_ntz")
    return F.convert_timezone(F.lit(zone), session_zone if session_zone is not None else F.current_timezone(),
                              wall_clock).cast("timestamp")


def fmt_ts(column: Column | str) -> Column:
    return F.date_format(_col(column), "yyyy-MM-dd HH:mm:ss")


def epoch_ms(column: Column | str) -> Column:
    return F.unix_millis(_col(column))


def epoch_s(column: Column | str) -> Column:
    return F.unix_seconds(_col(column))


# --- windows -------------------------------------------------------------------------------------------------------

def day_window(column: Column | str, offset: str = "16 hours") -> Column:
    """24-hour tumbling window; the default offset puts its edges at midnight of UTC+8."""
    return F.window(_col(column), "24 hours", "24 hours", offset)


def hour_window(column: Column | str) -> Column:
    return F.window(_col(column), "1 hour")


def tumbling(column: Column | str, length: str) -> Column:
    return F.window(_col(column), length)


def period_label(start: Column | str, minutes: int = 10, legacy: bool = False) -> Column:
    """`start,end` text of a period that begins at `start`.

    With `legacy` the end keeps the hour of the start, so the last period of an hour ends at `HH:60:00`.
    """
    start = _col(start)
    if legacy:
        hour = F.date_format(start, "yyyy-MM-dd HH")
        end_minute = F.lpad((F.minute(start) + F.lit(minutes)).cast("string"), 2, "0")
        end = F.concat(hour, F.lit(":"), end_minute, F.lit(":00"))
    else:
        end = fmt_ts(start + F.make_dt_interval(mins=F.lit(minutes)))
    return F.concat(fmt_ts(start), F.lit(","), end)


def period_start(column: Column | str, minutes: int = 10) -> Column:
    """Beginning of the period a time falls into."""
    return F.window(_col(column), f"{minutes} minutes").getField("start")


def lateness_seconds(event: Column | str, receive: Column | str) -> Column:
    """Whole seconds between event and receipt."""
    return F.unix_timestamp(_col(receive)) - F.unix_timestamp(_col(event))


def lateness_class(event: Column | str, receive: Column | str, threshold: int, inclusive: bool = True) -> Column:
    """`timely` or `delayed`; NULL when either time is missing."""
    late = lateness_seconds(event, receive)
    timely = late <= threshold if inclusive else late < threshold
    return F.when(timely, F.lit("timely")).when(~timely, F.lit("delayed"))
