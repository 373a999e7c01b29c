"""Date helpers with the calendar conventions of the source schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c: Column | str) -> Column:
    """yyyyMMdd as INT (the calendar's surrogate key)."""
    d = _col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def sql_server_week(c: Column | str) -> Column:
    """Week number where Jan 1 is in week 1 and weeks start on Sunday.

    This is not ISO ``weekofyear``: 2023-01-01 is week 1 (ISO: 52) and 2024-12-31 is
    week 53 (ISO: 1).
    """
    d = _col(c)
    jan1_weekday = F.dayofweek(F.trunc(d, "year"))  # Sunday = 1
    return (F.floor((F.dayofyear(d) + jan1_weekday - F.lit(2)) / F.lit(7)) + F.lit(1)).cast("int")


def day_boundaries(start: Column | str, end: Column | str) -> Column:
    """Number of day boundaries crossed from start to end (time of day ignored)."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def month_boundaries(start: Column | str, end: Column | str) -> Column:
    """Number of month boundaries crossed from start to end; may be negative.

    Not ``months_between``, which measures fractional months.
    """
    s, e = _col(start), _col(end)
    return ((F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))).cast("int")
