"""Registration cohorts.

Semantics of the source:

* The base joins every current customer to *all* fact lines (no return filter), so
  returns count in TransactionCount and LastPurchaseDate but not in TotalSpend.
* MonthsSinceCohort = month boundaries from registration to the **last** purchase:
  each customer is counted once, at their last active month (not the classic
  active-in-month-k matrix). Customers without facts have NULL there; they are in
  the summary but not in the matrices.
* Retention divides each cell by the cell at the smallest offset observed in the
  whole table (``denominator='first_offset'``, the source's behaviour), or by the
  cohort size (``denominator='cohort_size'``, the documented intent). A zero or
  missing denominator gives NULL.

Long form (cohort, offset, value) is the scalable output; ``to_wide`` pivots it with
an explicit, sorted list of offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.functions.dates import month_boundaries
from clientele.functions.numeric import round2, safe_ratio
from clientele.operators.ranking import top_k
from clientele.session import cut_lineage

OFFSET = "MonthsSinceCohort"


def cohort_base(customer: DataFrame, sales: DataFrame, purchase_flag: str = "N") -> DataFrame:
    per_customer = (sales.select("CustomerKey", "TransactionDate", "NetSalesAmount", "ReturnFlag")
                    .groupBy("CustomerKey").agg(
                        F.max("TransactionDate").alias("LastPurchaseDate"),
                        F.count(F.lit(1)).alias("_lines"),
                        F.sum(F.when(F.col("ReturnFlag") == purchase_flag, F.col("NetSalesAmount"))
                              .otherwise(F.lit(0))).alias("_spend")))
    c = customer.where(F.col("IsCurrentRecord")).select("CustomerKey", "CustomerID", "RegistrationDate")
    b = c.join(per_customer, "CustomerKey", "left")
    no_facts = F.col("_lines").isNull()
    return b.select(
        "CustomerKey", "CustomerID", "RegistrationDate",
        F.year("RegistrationDate").alias("CohortYear"),
        F.quarter("RegistrationDate").alias("CohortQuarter"),
        F.date_format("RegistrationDate", "yyyy-MM").alias("CohortMonth"),
        "LastPurchaseDate",
        F.coalesce(F.col("_lines"), F.lit(0).cast("long")).alias("TransactionCount"),
        # the outer join's NULL row falls into ELSE 0 in the source
        F.when(no_facts, F.lit(0).cast(per_customer.schema["_spend"].dataType))
         .otherwise(F.col("_spend")).alias("TotalSpend"),
        month_boundaries(F.col("RegistrationDate"), F.col("LastPurchaseDate")).alias(OFFSET),
    )


def cohort_summary(base: DataFrame) -> DataFrame:
    return base.groupBy(F.col("CohortMonth").alias("Cohort")).agg(
        F.count("CustomerKey").alias("CohortSize"),
        round2(F.sum("TotalSpend").cast("double")).alias("TotalRevenue"),
        round2(safe_ratio(F.sum("TotalSpend"), F.count("TotalSpend"))).alias("AvgSpend"),
        round2(safe_ratio(F.sum("TransactionCount"), F.count("TransactionCount"))).alias("AvgTransactions"),
    )


def _cells(base: DataFrame) -> DataFrame:
    return (base.where(F.col(OFFSET).isNotNull())
            .groupBy(F.col("CohortMonth").alias("Cohort"), F.col(OFFSET))
            .agg(F.count(F.lit(1)).alias("Customers")))


def cohort_retention(base: DataFrame, denominator: str = "first_offset") -> DataFrame:
    """Long form: Cohort, MonthsSinceCohort, Customers, Denominator, RetentionPct."""
    cells = _cells(base)
    if denominator == "first_offset":
        first = F.min(OFFSET).over(Window.partitionBy())  # over the aggregated cells: bounded by months
        per_cohort = Window.partitionBy("Cohort")  # one row per observed offset: bounded
        denom = F.coalesce(F.max(F.when(F.col(OFFSET) == F.col("_first"), F.col("Customers")))
                           .over(per_cohort), F.lit(0).cast("long"))
        out = cells.withColumn("_first", first).withColumn("Denominator", denom).drop("_first")
    elif denominator == "cohort_size":
        sizes = base.groupBy(F.col("CohortMonth").alias("Cohort")).agg(
            F.count("CustomerKey").alias("Denominator"))
        out = cells.join(sizes, "Cohort")
    else:
        raise ValueError(f"denominator must be 'first_offset' or 'cohort_size', not {denominator!r}")
    return out.withColumn("RetentionPct", safe_ratio(F.col("Customers"), F.col("Denominator")) * F.lit(100.0))


def cohort_spending(base: DataFrame) -> DataFrame:
    """Long form: Cohort, MonthsSinceCohort, AvgSpend (mean total spend in the cell)."""
    return (base.where(F.col(OFFSET).isNotNull())
            .groupBy(F.col("CohortMonth").alias("Cohort"), F.col(OFFSET))
            .agg(safe_ratio(F.sum("TotalSpend"), F.count("TotalSpend")).alias("AvgSpend")))


def to_wide(long: DataFrame, value: str, index: str = "Cohort", column: str = OFFSET,
            fill: float | int | None = 0) -> DataFrame:
    """Pivot a long cohort table; one column per observed offset, named by the offset.

    The offsets are collected first (one value per month of history, so bounded) and
    passed to ``pivot`` so Spark does not need its own discovery pass. The long table (a
    row per cohort and month) is written first, so the facts behind it are read once.
    """
    long = cut_lineage(long)
    offsets = sorted(r[0] for r in long.select(column).where(F.col(column).isNotNull())
                     .distinct().collect())
    wide = long.groupBy(index).pivot(column, offsets).agg(F.first(value))
    renamed = wide.select(index, *[F.col(f"`{o}`").alias(str(o)) for o in offsets])
    return renamed.fillna(fill) if fill is not None else renamed


def retention_wide(base: DataFrame) -> DataFrame:
    """The source's retention matrix: counts pivoted (missing = 0), each row divided by
    its value in the first (smallest) offset column, times 100."""
    counts = to_wide(_cells(base), "Customers")
    offsets = [c for c in counts.columns if c != "Cohort"]
    if not offsets:
        return counts
    first = F.col(f"`{offsets[0]}`")
    return counts.select("Cohort", *[(safe_ratio(F.col(f"`{o}`"), first) * F.lit(100.0)).alias(o)
                                     for o in offsets])


def to_long(wide: DataFrame, value: str, index: str = "Cohort", column: str = OFFSET) -> DataFrame:
    """A wide matrix as (index, column, value) over its full grid."""
    offsets = [c for c in wide.columns if c != index]
    if not offsets:
        return wide.select(index, F.lit(None).cast("int").alias(column),
                           F.lit(None).cast("double").alias(value)).where(F.lit(False))
    long = wide.unpivot([index], [f"`{o}`" for o in offsets], column, value)
    return long.withColumn(column, F.col(column).cast("int"))


def cohort_top_revenue(base: DataFrame, k: int = 5) -> DataFrame:
    rev = base.groupBy(F.col("CohortMonth").alias("Cohort")).agg(
        F.sum("TotalSpend").cast("double").alias("TotalRevenue"))
    return top_k(rev, [F.col("TotalRevenue").desc(), F.col("Cohort").asc()], k)


def cohort_active_rate(base: DataFrame, k: int = 5) -> DataFrame:
    rate = base.groupBy(F.col("CohortMonth").alias("Cohort")).agg(
        (safe_ratio(F.count_if(F.col("TransactionCount") > 0), F.count(F.lit(1)))
         * F.lit(100.0)).alias("ActiveRate"))
    return top_k(rate, [F.col("ActiveRate").desc(), F.col("Cohort").asc()], k)

