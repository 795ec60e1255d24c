"""Aggregate building blocks: conditional counts and sums, code matrices, packing and rates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

MONEY = "decimal(10,4)"
WIDE_MONEY = "decimal(18,4)"
RATE = "decimal(10,3)"


def count_where(condition: Column) -> Column:
    """Number of rows where `condition` holds; 0 rather than NULL when there are none."""
    return F.count_if(condition)


def money(column: Column | str) -> Column:
    """Amount as decimal(10,4). Missing, unreadable and too large amounts count as zero or vanish from sums alike."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.try_cast(MONEY), F.lit(0).cast(MONEY))


def cents(column: Column | str, wide: bool = False, exact: bool = False) -> Column:
    """`money` in ten-thousandths as a bigint: sums of these stay in machine words. A total beyond nine hundred
    trillion raises an overflow error.

    With `wide` only missing amounts and text that is no number count as zero. Amounts of a million and more, which
    `money` counts as zero, are summed, and one of a hundred trillion or more raises. `exact` says that the column is a
    decimal, which is never text without a number and needn't be tried.
    """
    if not wide:
        return (money(column) * 10_000).cast("bigint")
    column = F.col(column) if isinstance(column, str) else column
    readable = column if exact else F.when(column.try_cast("double").isNotNull(), column)
    return (F.coalesce(readable.cast(WIDE_MONEY), F.lit(0).cast(WIDE_MONEY)) * 10_000).cast("bigint")


def amount(total: str) -> str:
    """SQL text: sum of `cents` back as decimal(20,4), the type a sum of decimal(10,4) has. Most sums of a wide report
    are zero and skip the decimal arithmetic."""
    scaled = f"cast(cast({total} as decimal(20,0)) * 0.0001BD as decimal(20,4))"
    return f"case when {total} = 0 then cast(0 as decimal(20,4)) else {scaled} end"


def amount_text(total: str) -> str:
    """SQL text: `amount` as text."""
    return f"case when {total} = 0 then '0.0000' else cast({amount(total)} as string) end"


def count_text(total: str) -> str:
    """SQL text: a count as text; the zeros, which are most of a wide report, aren't written digit by digit."""
    return f"case when {total} = 0 then '0' else cast({total} as string) end"


def sum_where(weight: str, condition: str) -> str:
    """SQL text: sum of the bigint column `weight` over the rows where `condition` holds; 0 when there are none.

    The weight `1` counts the rows, which is cheaper than a sum: a count is never NULL and needn't be asked for it.
    """
    if weight == "1":
        return f"count(1) filter (where {condition})"
    return f"sum(case when {condition} then {weight} else 0L end)"


def code_matrix(weight: str, code: str, codes: Iterable[int], condition: str | None = None) -> list[str]:
    """One conditional sum of `weight` per code, all to be evaluated in a single aggregate."""
    prefix = f"{condition} and " if condition else ""
    return [sum_where(weight, f"{prefix}{code} = {value}") for value in codes]


def pack(cells: Column, outer: bool) -> Column:
    """Array to text: `|1|2|` with outer bars, `1|2` without."""
    text = F.array_join(cells, "|")
    return F.concat(F.lit("|"), text, F.lit("|")) if outer else text


def pack_cells(texts: list[str], outer: bool) -> str:
    """SQL text: `pack` of single text expressions, which need not become an array first."""
    ends = ["''"] if outer else []
    return f"concat_ws('|', {', '.join([*ends, *texts, *ends])})"


def pack_totals(totals: list[str], amounts: bool, outer: bool) -> str:
    """SQL text: `pack` of integer totals, counts or `cents`. A matrix of zeros, as of a medium that the key hasn't, is
    one constant text."""
    zeros = "|".join(["0.0000" if amounts else "0"] * len(totals))
    empty = " and ".join(f"{total} = 0" for total in totals)
    packed = pack_cells([amount_text(t) if amounts else count_text(t) for t in totals], outer)
    return f"case when {empty} then '{f'|{zeros}|' if outer else zeros}' else {packed} end"


def ratio(part: Column, whole: Column) -> Column:
    """Plain quotient, NULL for an empty denominator."""
    return F.try_divide(part, whole)


def rate(part: Column, whole: Column) -> Column:
    """Quotient to three decimals, NULL for an empty denominator."""
    return ratio(part, whole).cast(RATE)
