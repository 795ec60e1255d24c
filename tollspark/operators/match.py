"""Interval match: transactions against plate pictures within a time tolerance.

All variants join on the caller's keys plus a time bucket. A right row is copied into the at most two buckets its
tolerance interval touches, so a busy key is cut into slices of time and Spark never compares rows that are far
apart. The range predicate then decides exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tollspark.functions import rowkey, text

MATCHED, UNMATCHED = 99, 66  # fixed values: matching degree


def _slot(seconds: Column, width: int) -> Column:
    return F.floor(seconds / F.lit(width)).cast("bigint")


def _bucketed(left: DataFrame, right: DataFrame, on: list[str], lt: str, rt: str, tolerance: int,
              bucket: int | None) -> tuple[DataFrame, DataFrame]:
    width = max(bucket if bucket is not None else 2 * tolerance + 1, 1)
    lhs = left.withColumn("_slot", _slot(F.col(lt), width))
    keys = [F.col(k).alias(f"_r_{k}") for k in on]
    rest = [c for c in right.columns if c not in on]
    slots = F.sequence(_slot(F.col(rt) - tolerance, width), _slot(F.col(rt) + tolerance, width))
    rhs = right.select(*keys, *rest, F.explode(slots).alias("_r_slot"))
    return lhs, rhs


def _condition(on: list[str], lt: str, rt: str, tolerance: int, null_safe: bool, extra: Column | None) -> Column:
    cond = F.col("_slot") == F.col("_r_slot")
    for key in on:
        a, b = F.col(key), F.col(f"_r_{key}")
        cond = cond & (a.eqNullSafe(b) if null_safe else a == b)
    cond = cond & F.col(rt).between(F.col(lt) - tolerance, F.col(lt) + tolerance)
    return cond if extra is None else cond & extra


def interval_pairs(left: DataFrame, right: DataFrame, on: list[str], lt: str, rt: str, tolerance: int,
                   how: str = "left", null_safe: bool = False, bucket: int | None = None,
                   condition: Column | None = None) -> DataFrame:
    """One row per (left, right) pair with equal keys and |rt - lt| <= tolerance, bounds included.

    `lt` and `rt` are epoch seconds. With `how="left"` a left row without partner appears once with NULLs. Apart from
    the keys the two sides must not share column names. Keys compare with `=`, or as NULL-equals-NULL on request.
    A left row whose time is NULL has no partner.
    """
    lhs, rhs = _bucketed(left, right, on, lt, rt, tolerance, bucket)
    joined = lhs.join(rhs, _condition(on, lt, rt, tolerance, null_safe, condition), how)
    return joined.drop("_slot", "_r_slot", *[f"_r_{k}" for k in on])


def matched(left: DataFrame, right: DataFrame, on: list[str], lt: str, rt: str, tolerance: int,
            null_safe: bool = False, bucket: int | None = None) -> DataFrame:
    """Left rows that have a partner, each as often as it occurs."""
    return interval_pairs(left, right.select(*on, rt), on, lt, rt, tolerance, "left_semi", null_safe, bucket)


def unmatched(left: DataFrame, right: DataFrame, on: list[str], lt: str, rt: str, tolerance: int,
              null_safe: bool = False, bucket: int | None = None) -> DataFrame:
    """Left rows that have no partner."""
    return interval_pairs(left, right.select(*on, rt), on, lt, rt, tolerance, "left_anti", null_safe, bucket)


def _folded(left: DataFrame, unique_left: bool) -> DataFrame:
    """Left rows with the number of identical copies of each, so that grouping cannot merge them away."""
    if unique_left:
        return left.withColumn("_copies", F.lit(1).cast("bigint"))
    return left.groupBy(*left.columns).agg(F.count(F.lit(1)).alias("_copies"))


def _unfolded(folded: DataFrame, unique_left: bool) -> DataFrame:
    """Every row as often as it was. Copies come out in blocks, so no row carries an array as long as their number."""
    if unique_left:
        return folded.drop("_copies")
    block = 4096
    blocks = folded.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                               F.floor((F.col("_copies") - 1) / block))))
    size = F.least(F.lit(block), F.col("_copies") - F.col("_block") * block).cast("int")
    return blocks.withColumn("_one", F.explode(F.array_repeat(F.lit(1), size))).drop("_copies", "_block", "_one")


_TIMES = "_times"


def _counted(right: DataFrame, on: list[str], rt: str, collect: str) -> DataFrame:
    """Identical right rows as one with their number: they would meet the same partners, and no hash can part them."""
    return right.groupBy(*on, rt, collect).agg(F.count(F.lit(1)).alias(_TIMES))


def _values(counted: bool) -> Column:
    """The partners' values in order, repeated right rows as often as they occur."""
    if not counted:
        return F.transform("_hits", lambda h: h.getField("v"))
    return F.flatten(F.transform("_hits", lambda h: F.array_repeat(h.getField("v"), h.getField(_TIMES).cast("int"))))


def _collected(pairs: DataFrame, left_columns: list[str], rt: str, collect: str, carry: list[str],
               distinct: bool = False) -> DataFrame:
    """Gather each left row's partners in (time, id) order. The partial aggregate runs where the join ran, so what
    travels is about one row per left row, not one per pair."""
    hit = F.when(F.col(rt).isNotNull(), F.struct(F.col(rt).alias("t"), F.col(collect).alias("v"),
                                                 *[F.col(c).alias(c) for c in carry]))
    gather = F.collect_set(hit) if distinct else F.collect_list(hit)
    grouped = pairs.groupBy(*left_columns).agg(F.array_sort(gather).alias("_hits"))
    found = F.size("_hits") > 0
    return grouped.select(
        *left_columns, "_hits",
        F.when(found, F.lit(1)).otherwise(F.lit(0)).alias("sign"),
        F.when(found, F.lit(MATCHED)).otherwise(F.lit(UNMATCHED)).alias("degree"),
    )


def interval_match(left: DataFrame, right: DataFrame, on: list[str], lt: str, rt: str, tolerance: int, collect: str,
                   how: str = "left", null_safe: bool = False, bucket: int | None = None,
                   unique_left: bool = False, plate: str | None = None, default_plate: str | None = None,
                   repeated_right: bool = False) -> DataFrame:
    """Exactly one row per left row: its columns, `matches` (the `collect` values of its partners in time order, then
    by value), `sign` 1/0 and `degree` 99/66.

    `unique_left=True` promises that no two left rows are identical and saves one aggregation. With `default_plate`,
    the text that stands for an unread plate, rows whose key `plate` holds it match nothing instead of each other. With
    `repeated_right` identical right rows are joined once, with their number, and repeated in the result only: for pictures
    that were sent over and over.
    A slice of time with very many left rows is left to Spark's skew join: the grouping that follows has its own
    exchange, so its partition can be split. `bucketed_interval_match` also splits slices with very many right rows.
    """
    folded = _folded(left, unique_left)
    if default_plate is not None:
        right = right.where(~F.col(plate).eqNullSafe(F.lit(default_plate)))
    side = _counted(right, on, rt, collect) if repeated_right else right.select(*on, rt, collect)
    pairs = interval_pairs(folded, side, on, lt, rt, tolerance, how, null_safe, bucket)
    out = _collected(pairs, folded.columns, rt, collect, [_TIMES] if repeated_right else [])
    out = out.withColumn("matches", _values(repeated_right))
    return _unfolded(out, unique_left).select(*left.columns, "matches", "sign", "degree")


def bucketed_interval_match(left: DataFrame, right: DataFrame, on: list[str], lt: str, rt: str, tolerance: int,
                            collect: str, bucket: int, how: str = "left", hot_rows: int = 1_000_000,
                            null_safe: bool = False, unique_left: bool = False) -> DataFrame:
    """`interval_match` with hot (key, bucket) groups cut into a grid before the join.

    A group with more than `hot_rows` rows on either side is split by row hash into enough parts on that side, and the
    other side's rows of that group are copied to each part. Groups are counted as part of the plan (keys and times
    only, combined before the shuffle), and the hot ones are a table like any other: however many there are, all are
    cut, and nothing is collected. Identical right rows, which would all fall into one part, are joined once with their
    number.
    """
    folded = _folded(left, unique_left)
    lhs, rhs = _bucketed(folded, _counted(right, on, rt, collect), on, lt, rt, tolerance, bucket)
    slices = lhs.select(*on, F.col("_slot"), F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionAll(
        rhs.select(*[F.col(f"_r_{k}").alias(k) for k in on], F.col("_r_slot"), F.lit(0), F.lit(1)))
    sizes = slices.groupBy(*on, "_slot").agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    largest = F.greatest("_l", "_r")
    hot = sizes.where(largest > hot_rows).select(
        *[F.col(k).alias(f"_h_{k}") for k in on], F.col("_slot").alias("_h_slot"),
        F.ceil(F.greatest(F.col("_l"), F.lit(1)) / hot_rows).cast("int").alias("_parts_l"),
        F.ceil(F.greatest(F.col("_r"), F.lit(1)) / hot_rows).cast("int").alias("_parts_r"))

    def grid(side: DataFrame, keys: list[str], slot: str, own: str, other: str, mark: str) -> DataFrame:
        at = F.col(slot).eqNullSafe(F.col("_h_slot"))
        for key, name in zip(on, keys):
            at = at & F.col(name).eqNullSafe(F.col(f"_h_{key}"))
        payload = [F.col(c) for c in side.columns]
        spread = side.join(hot, at, "left")
        own_part = F.pmod(F.xxhash64(*payload), F.coalesce(F.col(f"_parts_{own}"), F.lit(1))).cast("int")
        copies = F.sequence(F.lit(0), F.coalesce(F.col(f"_parts_{other}"), F.lit(1)) - 1)
        return spread.select(*payload, own_part.alias(f"_{mark}_{own}"), F.explode(copies).alias(f"_{mark}_{other}"))

    lhs = grid(lhs, on, "_slot", "l", "r", "a")
    rhs = grid(rhs, [f"_r_{k}" for k in on], "_r_slot", "r", "l", "b")
    same_cell = (F.col("_a_l") == F.col("_b_l")) & (F.col("_a_r") == F.col("_b_r"))
    pairs = lhs.join(rhs, _condition(on, lt, rt, tolerance, null_safe, same_cell), how)
    out = _collected(pairs, folded.columns, rt, collect, [_TIMES])
    out = out.withColumn("matches", _values(True))
    return _unfolded(out, unique_left).select(*left.columns, "matches", "sign", "degree")


def _segments(plate: Column, pieces: int) -> list[Column]:
    """Signatures of the text cut into `pieces` nearly equal segments: `length:piece:text`."""
    length = F.length(plate)
    return [F.concat_ws(":", length, F.lit(i), F.substring(plate, start + 1, size))
            for i, (start, size) in enumerate(_cuts(length, pieces))]


def _cuts(length: Column, pieces: int) -> list[tuple[Column, Column]]:
    base = F.floor(length / pieces).cast("int")
    short = F.lit(pieces) - (length % pieces)
    return [((base * i + F.greatest(F.lit(i) - short, F.lit(0))).cast("int"),
             F.when(F.lit(i) >= short, base + 1).otherwise(base)) for i in range(pieces)]


def _probes(plate: Column, distance: int) -> Column:
    """Every signature a text within `distance` edits of `plate` may have in common with it.

    Of its distance + 1 segments one is left untouched and occurs in `plate`. The first i segments can have been
    shifted by at most i edits on their left and distance - i on their right, which leaves few places to look at
    (the multi-match-aware selection of the PassJoin paper, Li et al., VLDB 2011).
    """
    length, found = F.length(plate), []
    for drift in range(-distance, distance + 1):
        other = length + drift
        for i, (start, size) in enumerate(_cuts(other, distance + 1)):
            first = max(-i, -drift - (distance - i))
            last = min(i, -drift + (distance - i))
            for shift in range(first, last + 1):
                at = start + shift
                fits = (other >= 0) & (at >= 0) & (at + size <= length)
                found.append(F.when(fits, F.concat_ws(":", other, F.lit(i), F.substring(plate, at + 1, size))))
    return F.array_distinct(F.array_compact(F.array(*found)))


def fuzzy_interval_match(left: DataFrame, right: DataFrame, on: list[str], lt: str, rt: str, tolerance: int,
                         collect: str, left_plate: str, right_plate: str, max_distance: int = 1,
                         default_plate: str | None = text.NO_PLATE, how: str = "left", bucket: int | None = None,
                         unique_left: bool = False) -> DataFrame:
    """Interval match whose plates may differ by up to `max_distance` edits.

    Candidates share a plate segment as well as the keys and the time bucket, so a busy gantry is not compared plate
    by plate with itself. Left rows with the default plate, which match nothing, get no segment and meet no picture.
    Adds `plates`, the matched plates in the order of `matches`.
    """
    folded = _folded(left, unique_left)
    a, b = F.coalesce(F.col(left_plate), F.lit("")), F.coalesce(F.col(right_plate), F.lit(""))
    # Identical pictures are folded with their count: a pair may meet at several segments, and the set that undoes
    # that must not swallow true copies.
    pictures = right.groupBy(*on, rt, collect, right_plate).agg(F.count(F.lit(1)).alias("_n"))
    segments = F.array(*_segments(a, max_distance + 1))
    if default_plate is not None:
        segments = F.when(a == default_plate, F.array(F.lit(None).cast("string"))).otherwise(segments)
    lhs = folded.withColumn("_seg", F.explode(segments))
    rhs = pictures.withColumn("_seg", F.explode(_probes(b, max_distance)))
    close = text.edit_distance(left_plate, right_plate, default_plate, max_distance).between(0, max_distance)
    pairs = interval_pairs(lhs, rhs, [*on, "_seg"], lt, rt, tolerance, how, bucket=bucket, condition=close)
    out = _collected(pairs, folded.columns, rt, collect, [right_plate, "_n"], distinct=True)

    def unrolled(field: str) -> Column:
        return F.flatten(F.transform("_hits", lambda h: F.array_repeat(h.getField(field), h.getField("_n").cast("int"))))

    out = out.withColumn("matches", unrolled("v")).withColumn("plates", unrolled(right_plate))
    return _unfolded(out, unique_left).select(*left.columns, "matches", "plates", "sign", "degree")


def match_rows(found: DataFrame, run_time: str, trade_id: str = "trade_id", plate: str = "plate",
               buckets: int = 100) -> DataFrame:
    """Result table of the match: row key, picture ids as `/p1/p2`, run time, both plates, id, sign and degree."""
    joined = F.concat(F.lit("/"), F.array_join("matches", "/"))
    hit = F.col("sign") == 1
    return found.select(
        rowkey.row_key(trade_id, buckets).alias("rowkey"),
        F.when(hit, joined).otherwise(F.lit("")).alias("pic_ids"),
        F.lit(run_time).alias("run_time"),
        F.col(plate).alias("plate"),
        F.when(hit, F.col(plate)).otherwise(F.lit("")).alias("pic_plate"),
        F.col(trade_id).alias("trade_id"),
        "sign", "degree",
    )


def split_matches(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matched, unmatched) rows of a match result. Cache the input when both are written."""
    return rows.where("sign = 1"), rows.where("sign = 0")
