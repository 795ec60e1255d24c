"""Counts over windows, tokens, distinct tuples and latest rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from tollspark.functions import times

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds_of(interval: str) -> int:
    """`2 hours` to 7200."""
    amount, unit = interval.split()
    return int(amount) * _UNIT_SECONDS[unit.rstrip("s")]


def match_summary(rows: DataFrame) -> DataFrame:
    """Total, matched and unmatched rows of a match result, and how many distinct rows each has.

    Equal rows are counted together first; one shuffle gives the plain and the distinct counts alike.
    """
    per_row = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    hit, miss = F.col("sign") == 1, F.col("sign") == 0
    zero = F.lit(0).cast("bigint")

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("_n"))), zero)

    return per_row.agg(
        F.coalesce(F.sum("_n"), zero).alias("total"),
        total(hit).alias("matched"),
        total(miss).alias("unmatched"),
        F.count(F.lit(1)).alias("distinct_total"),
        F.count_if(hit).alias("distinct_matched"),
        F.count_if(miss).alias("distinct_unmatched"),
    )


def count_by(df: DataFrame, keys: list[str], length: str, event: str = "event_time") -> DataFrame:
    """Rows per key and tumbling window. Table or stream."""
    grouped = df.select(*keys, times.tumbling(event, length).alias("window")).groupBy(*keys, "window").count()
    return grouped.select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                          F.col("count").alias("n"))


def sliding_count(df: DataFrame, keys: list[str], length: str, slide: str, event: str = "event_time") -> DataFrame:
    """Rows per key and sliding window.

    On a table, rows are counted per pane (the greatest length that divides both intervals) and only the panes are
    copied into the windows that cover them. A stream uses Spark's own sliding window.
    """
    if df.isStreaming:
        grouped = df.select(*keys, F.window(event, length, slide).alias("window")).groupBy(*keys, "window").count()
        return grouped.select(*keys, F.col("window.start").alias("window_start"),
                              F.col("window.end").alias("window_end"), F.col("count").alias("n"))
    long, step = seconds_of(length), seconds_of(slide)
    pane = math.gcd(long, step)
    moment = F.unix_seconds(F.col(event).cast("timestamp"))
    # The dropna mirrors F.window, which has no window for a missing time.
    panes = df.select(*keys, (F.floor(moment / pane) * pane).cast("bigint").alias("_pane")).dropna(subset=["_pane"]) \
              .groupBy(*keys, "_pane").agg(F.count(F.lit(1)).alias("_n"))
    last = (F.floor(F.col("_pane") / step) * step).cast("bigint")
    first = (F.floor((F.col("_pane") - long) / step) * step + step).cast("bigint")
    windows = panes.where(first <= last).select(
        *keys, F.explode(F.sequence(first, last, F.lit(step).cast("bigint"))).alias("_start"), "_n")
    return windows.groupBy(*keys, "_start").agg(F.sum("_n").alias("n")).select(
        *keys, F.timestamp_seconds("_start").alias("window_start"),
        F.timestamp_seconds(F.col("_start") + long).alias("window_end"), "n")


def tokens(df: DataFrame, column: str, sep: str = " ") -> DataFrame:
    """One row per piece of the text between separators. Empty pieces at the end are dropped, others are kept."""
    quoted = "".join("\\" + c if c in r".^$*+?()[]{}|\\" else c for c in sep)
    text = F.col(column)
    body = F.when(text.endswith(sep), F.regexp_replace(text, f"(?:{quoted})+$", "")).otherwise(text)
    pieces = F.when((body == "") & (text != ""), F.array().cast("array<string>")).otherwise(F.split(body, quoted))
    return df.select(F.explode(pieces).alias("value"))


def token_count(df: DataFrame, column: str, sep: str = " ") -> DataFrame:
    """Occurrences of every piece. Table or stream."""
    return tokens(df, column, sep).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def distinct_lanes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of distinct tuples, counting those with a NULL member too."""
    return df.agg(F.count_distinct(F.struct(*columns)).alias("lanes"))


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest `order` per key; ties go to the greater remaining columns."""
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*order, *[c for c in rest if c not in order])
    newest = df.groupBy(*keys).agg(F.max(ranked).alias("_row"))
    return newest.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])
