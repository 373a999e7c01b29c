"""Date dimension: one row per day between two bounds (inclusive)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions.dates import date_key, sql_server_week

# Default bounds of the source calendar.
DEFAULT_START = _dt.date(2020, 1, 1)
DEFAULT_END = _dt.date(2030, 12, 31)


def calendar_rows(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Expand each (start, end) row into its days and derive the calendar columns."""
    days = bounds.select(F.explode(F.sequence(F.col(start).cast("date"), F.col(end).cast("date"),
                                              F.expr("interval 1 day"))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def calendar_columns(d: Column) -> list[Column]:
    weekday = F.dayofweek(d)  # Sunday = 1 .. Saturday = 7
    return [
        date_key(d).alias("DateKey"),
        d.alias("CalendarDate"),
        F.year(d).alias("Year"),
        F.quarter(d).alias("Quarter"),
        F.month(d).alias("Month"),
        F.dayofmonth(d).alias("Day"),
        sql_server_week(d).alias("WeekOfYear"),
        weekday.alias("DayOfWeek"),
        F.date_format(d, "EEEE").alias("DayName"),
        F.date_format(d, "MMMM").alias("MonthName"),
        weekday.isin(1, 7).alias("IsWeekend"),
        F.lit(False).alias("IsHoliday"),
    ]


def dim_date(spark: SparkSession, start: _dt.date = DEFAULT_START,
             end: _dt.date = DEFAULT_END) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return calendar_rows(bounds)


def calendar_for(dates: DataFrame, column: str) -> DataFrame:
    """Calendar covering whole years from the first to the last value of ``column``."""
    bounds = dates.agg(F.trunc(F.min(column), "year").alias("start"),
                       F.last_day(F.make_date(F.year(F.max(column)), F.lit(12), F.lit(1))).alias("end"))
    return calendar_rows(bounds)
