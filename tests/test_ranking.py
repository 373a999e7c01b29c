"""Distributed ranking, order statistics and scoring without size switches."""

import datetime
import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clientele.operators import ranking
from clientele.operators.ranking import BRACKET_ROWS, global_row_number, rows_at, sql_literal
from clientele.operators.reports import exact_median
from clientele.operators.rfm import rfm_scores


def test_global_row_number_matches_pandas(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice([1, 1, 1, 2, 3, 50]), rng.random()) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, hot int, v double").repartition(7)
    got = global_row_number(df, [F.col("hot").desc(), F.col("v").asc(), F.col("k").asc()], "r", "n",
                            partitions=5).toPandas()
    want = pd.DataFrame(rows, columns=["k", "hot", "v"]).sort_values(
        ["hot", "v", "k"], ascending=[False, True, True]).k.tolist()
    assert got.sort_values("r").k.tolist() == want
    assert got.r.min() == 1 and got.r.max() == 1000 and set(got.n) == {1000}


def test_global_row_number_empty(spark):
    df = spark.createDataFrame([], "k int")
    assert global_row_number(df, [F.col("k").asc()]).count() == 0


@pytest.mark.parametrize("n", [1, 2, BRACKET_ROWS, 5000])
def test_rows_at_any_position(spark, n):
    rng = random.Random(n)
    rows = [(i, rng.choice([-5, 0, 7]) if i % 3 else 3, Decimal(rng.randint(-999, 999)) / 100,
             datetime.datetime(2020, 1, 1) + datetime.timedelta(seconds=rng.randint(0, 50)),
             rng.choice(["a'b", "c\\d", ""])) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, a int, d decimal(15,2), t timestamp, s string").repartition(4)
    first = [("a", False), ("s", True), ("t", False), ("d", True), ("k", False)]
    second = [("d", False), ("k", True)]
    positions = sorted({1, (n + 1) // 2, max(1, n - 1), n})
    got = rows_at(df, n, {"one": (first, positions), "two": (second, positions)})
    one = sorted(rows, key=lambda r: (-r[1], r[4], -r[3].timestamp(), r[2], -r[0]))
    two = sorted(rows, key=lambda r: (-r[2], r[0]))
    for p in positions:
        k, a, d, t, s = one[p - 1]
        assert got["one"][p] == (a, s, t, d, k)
        assert got["two"][p] == (two[p - 1][2], two[p - 1][0])


def test_sql_literals_read_back(spark):
    values = [5, -5, 1 << 62, Decimal("-1.50"), 0.1, -1e300, "it's \\ x", True,
              datetime.date(2020, 2, 29), datetime.datetime(2020, 2, 29, 1, 2, 3, 450000)]
    row = spark.range(1).selectExpr(*(f"{sql_literal(v)} AS c{i}" for i, v in enumerate(values))).first()
    assert list(row) == values


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 6, 7, 101, 3000])
def test_scores_equal_qcut(spark, n):
    rng = random.Random(n)
    rows = [(i, rng.choice([1, 5, 5, 9]), rng.choice([1, 1, 2, 30]), Decimal(rng.randint(1, 500)) / 10)
            for i in range(n)]
    df = spark.createDataFrame(rows, "CustomerKey long, RecencyDays int, TransactionCount long, "
                                     "TotalSpend decimal(15,2)").repartition(3)
    got = {r.CustomerKey: (r.R_Score, r.F_Score, r.M_Score) for r in rfm_scores(df).collect()}
    assert len(got) == n

    def bins(order):
        ranked = sorted(rows, key=order)
        if n == 1:
            return {ranked[0][0]: 1}
        q = pd.qcut(pd.Series(range(1, n + 1)), 5, labels=False) + 1 if n else []
        return {r[0]: int(b) for r, b in zip(ranked, q)}
    r = bins(lambda x: (x[1], -x[3], x[0]))
    f = bins(lambda x: (x[2], -x[3], x[0]))
    m = bins(lambda x: (x[3], x[0]))
    assert got == {k: (6 - r[k], f[k], m[k]) for k in got}


def test_exact_median(spark):
    rng = random.Random(3)
    for n in (1, 2, 999, 1000):
        values = [round(rng.random() * 100, 2) for _ in range(n)]
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(-1, None)],
                                   "CustomerKey long, v double")
        assert exact_median(df, "v") == pytest.approx(pd.Series(values).median(), abs=1e-12)
    assert exact_median(df.where("v is null"), "v") is None


DOUBLES = [0.0, 1.5, -1.5, 0.01, -0.01, 3.0, 3.0000000000000004, 1000.25]


@pytest.mark.parametrize("kind,values", [
    ("double", DOUBLES), ("long", [-(1 << 63), (1 << 63) - 1, 0, -1, 1, 1 << 40]), ("boolean", [True, False]),
    ("decimal(38,2)", [Decimal("-99999999999999999999999999999999.99"), Decimal("0.01"), Decimal(10) ** 33, Decimal("1.10")]),
    ("date", [datetime.date(1, 1, 2), datetime.date(1969, 12, 31), datetime.date(2024, 2, 29)]),
    ("timestamp", [datetime.datetime(1900, 1, 1), datetime.datetime(2024, 1, 1, 0, 0, 0, 1), datetime.datetime(2024, 1, 1)]),
    ("string", ["", "a", "a\0", "ab", "abcdefg", "abcdefgh", "abcdefg\0", "\U0001f600", "\uffff"]),
])
def test_rows_at_orders_every_type(spark, monkeypatch, kind, values):
    """Down to single rows by digits alone, in both directions, with ties."""
    monkeypatch.setattr(ranking, "BRACKET_ROWS", 1)
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values * 2)], f"v {kind}, t int")
    n = 2 * len(values)
    up = sorted(values * 2, key=(lambda v: v.encode()) if kind == "string" else None)
    at = [1, n // 2, n]
    got = rows_at(df, n, {"up": ([("v", True)], at), "down": ([("v", False)], at)})
    assert [got["up"][p][0] for p in at] == [up[p - 1] for p in at]
    assert [got["down"][p][0] for p in at] == [up[-p] for p in at]


def test_rows_at_reads_once_per_digit(spark, monkeypatch, tmp_path):
    """The number of reads does not depend on the number of positions."""
    spark.range(20_000).selectExpr("id", "id * 7919 % 20011 AS v", "cast(id % 3 as decimal(15,2)) AS d").write.parquet(
        str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    counted = []
    for positions in ([10_000], list(range(1, 20_000, 500))):
        jobs = []
        for method in ("collect", "first"):
            original = getattr(type(df), method)

            def count(self, *args, _original=original, _jobs=jobs):
                _jobs.append(1)
                return _original(self, *args)
            monkeypatch.setattr(type(df), method, count)
        got = rows_at(df, 20_000, {"v": ([("v", True), ("id", True)], positions),
                                   "d": ([("d", False), ("v", True), ("id", True)], positions)})
        assert set(got["v"]) == set(positions)
        monkeypatch.undo()
        counted.append(len(jobs))
    assert counted[0] == counted[1] <= 6
