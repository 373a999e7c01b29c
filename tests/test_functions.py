import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from clientele.functions import month_boundaries, quantile_tile, round2, sql_server_week


def test_quantile_tile_equals_qcut(spark):
    sizes = list(range(2, 130)) + [997, 1001, 1499]
    rows = [(n, r) for n in sizes for r in range(1, n + 1)]
    df = spark.createDataFrame(rows, "n long, r long")
    got = df.select("n", "r", quantile_tile("r", "n", 5).alias("q")).toPandas()
    for n, part in got.groupby("n"):
        part = part.sort_values("r")
        expected = pd.qcut(part["r"].astype(float), q=5, labels=[1, 2, 3, 4, 5]).astype(int)
        assert list(part["q"]) == list(expected), n


def test_quantile_tile_is_not_ntile(spark):
    df = spark.createDataFrame([(7, r) for r in range(1, 8)], "n long, r long")
    got = [row.q for row in df.orderBy("r").select(quantile_tile("r", "n").alias("q")).collect()]
    assert got == [1, 1, 2, 3, 4, 5, 5]


def test_quantile_tile_degenerate_sizes(spark):
    df = spark.createDataFrame([(1, 1), (0, 1)], "n long, r long")
    assert [r.q for r in df.select(quantile_tile("r", "n").alias("q")).collect()] == [1, 1]


def test_round2_matches_numpy(spark):
    rng = np.random.default_rng(7)
    values = list(np.round(rng.uniform(0, 5000, 3000), 3)) + [417.985, 2.675, 1.005, 0.125, -0.125]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [r.y for r in df.select(round2("x").alias("y")).collect()]
    assert got == [float(np.round(v, 2)) for v in values]
    assert float(np.round(417.985, 2)) == 417.98


def test_week_numbers(spark):
    cases = {dt.date(2020, 1, 1): 1, dt.date(2020, 1, 5): 2, dt.date(2023, 1, 1): 1,
             dt.date(2024, 12, 31): 53}
    df = spark.createDataFrame([(d,) for d in cases], "d date")
    got = {r.d: r.w for r in df.select("d", sql_server_week("d").alias("w")).collect()}
    assert got == cases


def test_month_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 31), dt.date(2021, 2, 1)),
                                (dt.date(2021, 3, 1), dt.date(2020, 12, 31))], "a date, b date")
    got = [r.m for r in df.select(month_boundaries("a", "b").alias("m")).collect()]
    assert got == [1, -3]


def test_calendar_weeks_and_names_against_brute_force(spark):
    from clientele.operators.calendar import dim_date

    start, end = dt.date(2019, 1, 1), dt.date(2031, 12, 31)
    expected = {}
    d, week = start, 1
    while d <= end:
        if d.month == 1 and d.day == 1:
            week = 1
        elif d.isoweekday() == 7:  # a Sunday after Jan 1 starts the next week
            week += 1
        expected[d] = (week, d.isoweekday() % 7 + 1, d.strftime("%A"), d.strftime("%B"),
                       d.isoweekday() in (6, 7))
        d += dt.timedelta(days=1)
    got = {r.CalendarDate: (r.WeekOfYear, r.DayOfWeek, r.DayName, r.MonthName, r.IsWeekend)
           for r in dim_date(spark, start, end).collect()}
    assert got == expected
