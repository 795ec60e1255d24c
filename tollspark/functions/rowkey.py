"""Salted row keys: `<bucket prefix><key><suffix>`, the bucket taken from the Java string hash of the key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_WORD = 0xFFFFFFFF


def java_hash(column: Column | str) -> Column:
    """Java's `String.hashCode` as a bigint, over UTF-16 units."""
    column = F.col(column) if isinstance(column, str) else column
    points = F.transform(F.sequence(F.lit(1), F.length(column)),
                         lambda i: F.ascii(F.substring(column, i, F.lit(1))).cast("bigint"))

    def step(acc: Column, point: Column) -> Column:
        above = point - 0x10000
        pair = (acc * 31 + F.shiftright(above, 10) + 0xD800) * 31 + above.bitwiseAND(F.lit(0x3FF)) + 0xDC00
        return F.when(point < 0x10000, acc * 31 + point).otherwise(pair).bitwiseAND(F.lit(_WORD))

    word = F.aggregate(points, F.lit(0).cast("bigint"), step)
    signed = F.when(word >= 2 ** 31, word - 2 ** 32).otherwise(word)
    return F.when(F.length(column) == 0, F.lit(0).cast("bigint")).otherwise(signed)


def prefix_width(buckets: int) -> int:
    """Digits of the bucket prefix: 100 buckets are 00-99 and 1000 are 000-999."""
    # The layout of existing keys.
    if buckets <= 10 or buckets == 100:
        return 2
    return 3 if buckets == 1000 else len(str(buckets))


def row_key(column: Column | str, buckets: int = 100, suffix: str = "") -> Column:
    """Row key that spreads consecutive keys over `buckets` ranges. NULL and empty keys have none."""
    column = F.col(column) if isinstance(column, str) else column
    if buckets <= 1:
        return F.concat(column, F.lit(suffix))
    bucket = F.pmod(F.abs(java_hash(column)), F.lit(buckets))
    prefix = F.lpad(bucket.cast("string"), prefix_width(buckets), "0")
    return F.when(F.length(column) > 0, F.concat(prefix, column, F.lit(suffix)))
