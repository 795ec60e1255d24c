"""Text predicates and extractors used by the rate jobs and the plate match."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Fixed values.
SPECIAL_TYPES = range(155, 185)
NO_PLATE = "默A00000_9"
NO_PLATE_DISTANCE = 9
NOT_INSTALLED = "2"
NO_DATA = "无数据"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def not_special(column: Column | str, codes: Iterable[int] = SPECIAL_TYPES) -> Column:
    """True unless a bar-separated code list names one of `codes`. Missing and empty lists pass.

    One regular expression over the text keeps this inside generated code; splitting into an array would not.
    """
    column = _col(column)
    listed = column.rlike(r"(?:^|\|)\+?0*(?:" + "|".join(str(code) for code in codes) + r")(?:\||$)")
    return F.coalesce(~listed, F.lit(True))


def status_ok_no_zero(column: Column | str) -> Column:
    """Device status without any `0` digit that is not the not-installed code."""
    column = _col(column)
    return (F.instr(column, "0") == 0) & (column != NOT_INSTALLED)


def status_ok_zero_code(column: Column | str) -> Column:
    """Device status that is exactly a zero code."""
    return _col(column).isin("0", "00")


def installed(column: Column | str) -> Column:
    return _col(column) != NOT_INSTALLED


def drop_sentinel(df, column: str, value: str = NO_DATA):
    """Rows whose `column` is known: neither NULL nor the sentinel text."""
    return df.where(F.col(column) != F.lit(value))


def edit_distance(left: Column | str, right: Column | str, default_plate: str | None = NO_PLATE,
                  limit: int | None = None) -> Column:
    """Levenshtein distance with missing text taken as empty; the default plate is always 9 away.

    With `limit`, distances beyond it come back as -1, which lets Spark stop early.
    """
    left, right = _col(left), _col(right)
    a, b = F.coalesce(left, F.lit("")), F.coalesce(right, F.lit(""))
    distance = F.levenshtein(a, b) if limit is None else F.levenshtein(a, b, limit)
    if default_plate is None:
        return distance
    far = NO_PLATE_DISTANCE if limit is None or limit >= NO_PLATE_DISTANCE else -1
    return F.when(left == default_plate, F.lit(far)).otherwise(distance)


def _member(field: str) -> str:
    """Pattern of a text member with just this name; its group is everything up to the closing quote."""
    return rf'"{field}"\s*:\s*"([^"]*)"'


def find_all(column: Column | str, field: str) -> Column:
    """Values of every quoted JSON member named `field` in the text, in order of appearance."""
    return F.regexp_extract_all(_col(column), F.lit(_member(field)), F.lit(1))


def find_first(column: Column | str, field: str) -> Column:
    """First value of `field` in the text, NULL when it does not occur."""
    column = _col(column)
    return F.when(column.rlike(_member(field)), F.regexp_extract(column, _member(field), 1))


def find_count(column: Column | str, pattern: str) -> Column:
    return F.regexp_count(_col(column), F.lit(pattern))


def find_count_equal(column: Column | str, field: str, value: str) -> Column:
    """How many members named `field` hold exactly `value`, whatever signs it has."""
    literal = value.replace("\\E", "\\E\\\\E\\Q")
    return find_count(column, rf'"{field}"\s*:\s*"\Q{literal}\E"')


def count_members(column: Column | str, field: str) -> Column:
    """How many quoted members named `field` the text has."""
    return find_count(column, _member(field))


def or_blank(column: Column | str) -> Column:
    return F.coalesce(_col(column), F.lit(""))


def or_zero(column: Column | str) -> Column:
    return F.coalesce(_col(column), F.lit(0).cast("bigint"))
