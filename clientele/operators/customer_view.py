"""Customer single view: one row per customer with purchase history.

Semantics of the source view:

* The fact join keeps purchase lines only (return flag ``N`` in the ON clause), so
  ReturnCount is always 0 and TransactionCount equals PurchaseCount.
* A customer without purchase lines ends with zero counts and is removed by the final
  ``TotalSpend > 0 OR TransactionCount > 0``; the view is therefore an inner join and
  the 'Never Purchased' band cannot occur.
* PrimaryRegion, Country and State are three independent maxima, not a modal region.
* MonthsActive counts distinct months of the year (1..12), not year-months.
* RecencyDays counts day boundaries from the last sale *timestamp* to ``as_of``.

Plan: plain hash aggregation throughout. Region names, countries and states
are coded as integers on their dimension, once (codes follow the texts' order, so the maximum
of codes is the maximum of texts); lines are joined with the codes only, aggregated by
(customer, category) and then by customer, and the codes of the result are decoded. Both
aggregations combine map-side, so a customer with a third of all lines sends one row per
category and task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.functions.dates import day_boundaries
from clientele.functions.numeric import safe_ratio
from clientele.session import cut_lineage

RECENCY_BANDS = (  # fixed values: upper bound in days, label
    (30, "Very Recent"),
    (90, "Recent"),
    (180, "Moderate"),
)
RECENCY_NEVER = "Never Purchased"
RECENCY_OTHER = "Distant"


def as_of_literal(as_of: _dt.date | str) -> Column:
    return F.lit(str(as_of)).cast("date")


def recency_category(days: Column) -> Column:
    band = F.when(days.isNull(), F.lit(RECENCY_NEVER))
    for bound, label in RECENCY_BANDS:
        band = band.when(days <= bound, F.lit(label))
    return band.otherwise(F.lit(RECENCY_OTHER))


PLACES = ("RegionName", "Country", "State")


def coded_places(region: DataFrame) -> DataFrame:
    """RegionKey, names and their codes, which follow the names' order; null has no code."""
    def code(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.dense_rank().over(Window.orderBy(F.col(c))))
    return region.select("RegionKey", *PLACES, *(code(c).alias(f"{c}Code") for c in PLACES))


def purchase_metrics(sales: DataFrame, product: DataFrame, region: DataFrame,
                     purchase_flag: str = "N") -> DataFrame:
    """Per-customer aggregate over purchase lines (the CTE of the view)."""
    # written once: the codes are joined to the lines, and three times to decode the result
    coded_region = cut_lineage(coded_places(region))
    lines = (sales.where(F.col("ReturnFlag") == purchase_flag)
             .select("CustomerKey", "ProductKey", "RegionKey", "TransactionDate",
                     "NetSalesAmount", "ReturnFlag"))
    lines = (lines
             .join(coded_region.select("RegionKey", *(f"{c}Code" for c in PLACES)), "RegionKey", "left")
             .join(product.select("ProductKey", "Category"), "ProductKey", "left"))
    month_bit = F.call_function("shiftleft", F.lit(1), F.month("TransactionDate") - F.lit(1))
    bought = F.col("ReturnFlag") == purchase_flag
    by_category = lines.groupBy("CustomerKey", "Category").agg(
        F.max("TransactionDate").alias("last"),
        F.count(F.lit(1)).alias("lines"),
        F.sum("NetSalesAmount").alias("spend"),
        F.count_if(bought).alias("bought"),
        F.count_if(~bought).alias("returned"),
        F.bit_or(month_bit).alias("months"),  # months of the year as a 12-bit set
        *(F.max(f"{c}Code").alias(f"{c}Code") for c in PLACES))
    totals = by_category.groupBy("CustomerKey").agg(
        F.max("last").alias("LastPurchaseDate"),
        F.sum("lines").alias("TransactionCount"),
        F.sum("spend").cast(by_category.schema["spend"].dataType).alias("TotalSpend"),
        F.sum("bought").alias("PurchaseCount"),
        F.sum("returned").alias("ReturnCount"),
        F.bit_count(F.bit_or("months")).cast("int").alias("MonthsActive"),
        *(F.max(f"{c}Code").alias(f"{c}Code") for c in PLACES),
        F.count("Category").alias("CategoriesPurchased"))
    for c in PLACES:
        names = coded_region.select(f"{c}Code", c).where(F.col(c).isNotNull()).distinct()
        totals = totals.join(names, f"{c}Code", "left").drop(f"{c}Code")
    return totals.withColumnRenamed("RegionName", "PrimaryRegion")


def customer_single_view(customer: DataFrame, sales: DataFrame, product: DataFrame,
                         region: DataFrame, as_of: _dt.date | str) -> DataFrame:
    as_of_d = as_of_literal(as_of)
    metrics = purchase_metrics(sales, product, region)
    cust = customer.where(F.col("IsCurrentRecord")).select(
        "CustomerKey", "CustomerID", "CustomerName", "Email", "Phone", "RegistrationDate")
    v = cust.join(metrics, "CustomerKey", "inner")
    recency = day_boundaries(F.col("LastPurchaseDate"), as_of_d)
    return v.select(
        "CustomerKey", "CustomerID", "CustomerName", "Email", "Phone", "RegistrationDate",
        recency.alias("RecencyDays"),
        "TransactionCount", "TotalSpend", "PurchaseCount", "ReturnCount",
        safe_ratio(F.col("TotalSpend"), F.col("PurchaseCount")).alias("AvgOrderValue"),
        day_boundaries(F.col("RegistrationDate"), as_of_d).alias("CustomerTenureDays"),
        F.year("RegistrationDate").alias("CohortYear"),
        F.quarter("RegistrationDate").alias("CohortQuarter"),
        F.month("RegistrationDate").alias("CohortMonth"),
        "MonthsActive", "PrimaryRegion", "Country", "State", "LastPurchaseDate",
        "CategoriesPurchased",
        recency_category(recency).alias("RecencyCategory"),
    )


def customer_extract(view: DataFrame) -> DataFrame:
    """Rows the scoring reads: customers with positive spend (NULL spend is dropped)."""
    return view.where(F.col("TotalSpend") > 0)
