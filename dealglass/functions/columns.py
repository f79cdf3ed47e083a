"""Exact decimal arithmetic, calendar columns and conditional counts.

Everything here is a composition of built-in column functions, so it stays
inside whole-stage code generation.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def dec(text: str) -> Column:
    """A decimal literal; keeps weights exact where a double would not be."""
    return F.lit(Decimal(text))


def money(col: Column) -> Column:
    return col.cast("decimal(15,2)")


def half_up(col: Column, digits: int = 2) -> Column:
    """Round half away from zero (``F.round`` on decimals), not banker's rounding."""
    return F.round(col, digits)


def quotient(num: Column, den: Column, digits: int = 2) -> Column:
    """``num / den`` rounded half up; null when the denominator is zero or null.

    The casts leave at least 12 digits after the point before the final
    rounding, which keeps the result equal to exact arithmetic.
    """
    top = num.cast("decimal(24,2)")
    bottom = F.nullif(den.cast("decimal(20,2)"), F.lit(0).cast("decimal(20,2)"))
    return half_up(top / bottom, digits)


def percent(num: Column, den: Column, digits: int = 2) -> Column:
    """``100 * num / den`` rounded half up, null-safe on a zero denominator."""
    return quotient(num.cast("decimal(21,2)") * F.lit(100), den, digits)


def mean(total: Column, count: Column, digits: int = 2) -> Column:
    """Average from a sum and a count, rounded once."""
    return quotient(total, count, digits)


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def sum_where(cond: Column, value: Column) -> Column:
    """Sum over matching rows; zero (not null) for a group without a match."""
    return F.sum(F.when(cond, value).otherwise(F.lit(0).cast("decimal(15,2)")))


def zero(col: Column) -> Column:
    """Null to zero, for rollups attached with a left join."""
    return F.coalesce(col, F.lit(0))


def day(col: Column) -> Column:
    return col.cast("date")


def month(col: Column) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(day(col), "MM")


def on(as_of: dt.date) -> Column:
    """The date every operator uses in place of the current date."""
    return F.lit(as_of)


def moment(at: dt.datetime) -> Column:
    """A wall-clock time without a zone; the same in every session time zone."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def days_until(as_of: dt.date, since: Column) -> Column:
    """Whole days from ``since`` up to ``as_of``; negative for a future date."""
    return F.datediff(on(as_of), day(since))


def stable_id(*natural_key: Column) -> Column:
    """An id from the natural key: the same row gets the same id on every load.

    The parts are hashed as a JSON object, so nulls and separators count.
    """
    parts = [c.cast("string").alias(f"k{i}") for i, c in enumerate(natural_key)]
    return F.md5(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}))
