"""Dimensions with versions: change detection, closing and opening, lookups by time."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clientele.operators.versions import keys_at, merge_versions

SCHEMA = "CustomerID string, Name string, Status string"
DAYS = [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)]


def merged(spark, existing, rows, day):
    return merge_versions(existing, spark.createDataFrame(rows, SCHEMA), "CustomerID",
                          "CustomerKey", ["Name", "Status"], day)


def listed(versions):
    return sorted((r.CustomerKey, r.CustomerID, r.Status, str(r.ValidFrom), r.ValidTo and str(r.ValidTo),
                   r.IsCurrentRecord) for r in versions.collect())


def test_versions_open_and_close(spark):
    first = merged(spark, None, [("a", "A", "new"), ("b", "B", None), ("c", "C", "new"),
                                 (None, "N", "new"), ("c", "C", "old"), ("a", "A", "new")], DAYS[0])
    assert listed(first) == [(1, "a", "new", "2024-01-01", None, True),
                             (2, "b", None, "2024-01-01", None, True),
                             (3, "c", "new", "2024-01-01", None, True)]
    again = merged(spark, first, [("a", "A", "new"), ("b", "B", None)], DAYS[1])
    assert listed(again) == listed(first)          # nulls are equal; c is not named, so it stays
    second = merged(spark, first, [("d", "D", "new"), ("b", "B", "new"), ("a", "A", "old")], DAYS[1])
    assert listed(second) == [(1, "a", "new", "2024-01-01", "2024-02-01", False),
                              (2, "b", None, "2024-01-01", "2024-02-01", False),
                              (3, "c", "new", "2024-01-01", None, True),
                              (4, "a", "old", "2024-02-01", None, True),
                              (5, "b", "new", "2024-02-01", None, True),
                              (6, "d", "new", "2024-02-01", None, True)]
    third = merged(spark, second, [("a", "A", "new"), ("b", "B", None)], DAYS[2])
    assert [v for v in listed(third) if v[1] == "a"] == [
        (1, "a", "new", "2024-01-01", "2024-02-01", False),
        (4, "a", "old", "2024-02-01", "2024-03-01", False), (7, "a", "new", "2024-03-01", None, True)]
    current = third.where("IsCurrentRecord").groupBy("CustomerID").count().collect()
    assert {r.CustomerID: r["count"] for r in current} == dict.fromkeys("abcd", 1)
    with pytest.raises(ValueError, match="after 2024-01-01"):
        merged(spark, third, [("a", "A", "old")], DAYS[0])

    times = [("a", "2023-12-31 00:00:00"), ("a", "2024-01-01 00:00:00"), ("a", "2024-01-31 23:59:59"),
             ("a", "2024-02-01 00:00:00"), ("a", "2024-03-01 00:00:01"), ("z", "2024-02-01 00:00:00"),
             ("c", "2030-01-01 00:00:00"), ("a", None), (None, "2024-02-01 00:00:00")]
    rows = spark.createDataFrame(times, "CustomerID string, t string").withColumn(
        "t", F.col("t").cast("timestamp"))
    found = [(r.CustomerID, r.t and str(r.t)[:10], r.CustomerKey)
             for r in keys_at(rows, third, "CustomerID", "CustomerKey", "t").collect()]
    assert len(found) == len(times)
    assert {f[2] for f in found if f[:2] == ("a", "2024-01-01") or f[:2] == ("a", "2024-01-31")} == {1}
    assert ("a", "2024-02-01", 4) in found and ("a", "2024-03-01", 7) in found
    assert ("c", "2030-01-01", 3) in found
    assert sum(f[2] is None for f in found) == 4   # before the first, unknown, no time, no member


def test_empty_tables(spark):
    none = merged(spark, None, [], DAYS[0])
    assert none.count() == 0
    assert listed(merged(spark, none, [("a", "A", "x")], DAYS[1])) == [
        (1, "a", "x", "2024-02-01", None, True)]


def test_filter_of_current_records_matters(spark):
    """Without it, customers with closed versions come several times."""
    from data_folders import SMALL

    from clientele.plans import queries as Q

    customer, view = Q.versioned_view(spark, SMALL)
    everyone = Q.versioned_view(spark, SMALL, customer.withColumn("IsCurrentRecord", F.lit(True)))[1]
    assert customer.where("NOT IsCurrentRecord").count() > 0
    assert everyone.count() > view.count() == view.select("CustomerID").distinct().count()
    assert everyone.count() > everyone.select("CustomerID").distinct().count()
