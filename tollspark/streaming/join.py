"""Stream-stream joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tollspark.operators.summary import seconds_of
from tollspark.streaming.runs import with_lateness


def stream_interval_match(left: DataFrame, right: DataFrame, on: list[str], lt: str, rt: str, tolerance: int,
                          delay: str = "1 day", how: str = "leftOuter") -> DataFrame:
    """Pairs of two streams with equal keys and |rt - lt| <= tolerance seconds; left rows without partner follow once
    the watermark has passed them.

    `lt` and `rt` are event-time columns. As in the batch match, a time bucket is part of the join key, so the state
    looked up for a row is one slice of time and not everything its key has buffered.
    """
    width = 2 * tolerance + 1
    lhs = with_lateness(left, lt, delay).withColumn("_slot", F.floor(F.unix_seconds(lt) / width))
    first, last = (F.floor((F.unix_seconds(rt) + sign * tolerance) / width) for sign in (-1, 1))
    rhs = with_lateness(right, rt, delay).select(
        *[F.col(k).alias(f"_r_{k}") for k in on], *[c for c in right.columns if c not in on],
        F.explode(F.sequence(first, last)).alias("_r_slot"))
    reach = F.expr(f"interval {tolerance} seconds")
    cond = (F.col("_slot") == F.col("_r_slot")) & F.col(rt).between(F.col(lt) - reach, F.col(lt) + reach)
    for key in on:
        cond = cond & (F.col(key) == F.col(f"_r_{key}"))
    joined = lhs.join(rhs, cond, how)
    return joined.drop("_slot", "_r_slot", *[f"_r_{k}" for k in on])


def joined_count(pairs: DataFrame, time: str, length: str = "1 day") -> DataFrame:
    """Number of joined rows, those without partner included, per window of the left time `time`; a window follows once
    the watermark has passed it."""
    counts = pairs.groupBy(F.window(time, length).alias("window")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), "n")


def stream_left_join(left: DataFrame, right: DataFrame, on: list[str], lt: str, rt: str, within: str = "1 hour",
                     delay: str = "1 day") -> DataFrame:
    """Left outer equi-join of two streams. `within` bounds how far apart partners may be in event time; without such
    a bound neither side's state could ever be dropped."""
    return stream_interval_match(left, right, on, lt, rt, seconds_of(within), delay)
