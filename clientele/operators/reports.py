"""Report tables drawn from the scored customer table (view -> RFM -> CLV).

Means and sums of money and of rounded scores are computed from exact DECIMAL sums,
so they do not depend on how Spark partitions the rows. Top-k reports sort with a
full tie-break and carry a Rank column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.functions.numeric import exact_mean, exact_sum, round2, round_to, safe_ratio
from clientele.operators.ranking import rows_at, top_k
from clientele.operators.rfm import CHURN_SEGMENTS

# Segments counted as "Champions + Loyal" in the KPI block.
TOP_SEGMENTS = ("Champions", "Loyal Customers")
CHURN_FALLBACK_SCORE = 2.5


def segment_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("Segment").agg(
        F.count("CustomerID").alias("Customers"),
        exact_mean("RFM_Score").alias("Avg_RFM_Score"),
        F.sum("TotalSpend").cast("double").alias("Total_Spend"),
        exact_mean("CLV_Predicted").alias("Avg_CLV"),
    )


def segment_share(df: DataFrame) -> DataFrame:
    """Segment, customers, share of all customers (%), average spend."""
    per = df.groupBy("Segment").agg(
        F.count(F.lit(1)).alias("Customers"),
        safe_ratio(F.sum("TotalSpend"), F.count("TotalSpend")).alias("AvgSpend"))
    total = F.sum("Customers").over(Window.partitionBy())  # over one row per segment
    return per.withColumn("Percent", safe_ratio(F.col("Customers"), total) * F.lit(100.0))


def score_distribution(df: DataFrame) -> DataFrame:
    """Histogram of each score: (Dimension, Score, Customers)."""
    long = df.select(F.explode(F.array(
        F.struct(F.lit("R").alias("Dimension"), F.col("R_Score").alias("Score")),
        F.struct(F.lit("F").alias("Dimension"), F.col("F_Score").alias("Score")),
        F.struct(F.lit("M").alias("Dimension"), F.col("M_Score").alias("Score")))).alias("d"))
    return long.groupBy("d.Dimension", "d.Score").agg(F.count(F.lit(1)).alias("Customers"))


def rfm_stats(df: DataFrame) -> DataFrame:
    return df.agg(exact_mean("RFM_Score").alias("MeanRFM"), F.min("RFM_Score").alias("MinRFM"),
                  F.max("RFM_Score").alias("MaxRFM"))


def exact_median(df: DataFrame, column: str, tie_break: Sequence[str] = ("CustomerKey",)) -> float | None:
    """Median as the mean of the two middle values, found by narrowing brackets.

    ``median``/``percentile`` keep every value of the group in one buffer; ``rows_at`` only
    counts. None without values.
    """
    known = df.select(column, *tie_break).where(F.col(column).isNotNull())
    n = known.count()
    if n == 0:
        return None
    order = [(column, True), *((c, True) for c in tie_break)]
    low, high = (n + 1) // 2, n // 2 + 1
    middle = rows_at(known, n, {column: (order, sorted({low, high}))})[column]
    return (middle[low][0] + middle[high][0]) / 2.0


def clv_stats(df: DataFrame) -> DataFrame:
    """Mean, exact median and maximum CLV (one row)."""
    median = F.lit(exact_median(df, "CLV_Predicted")).cast("double")
    return df.agg(exact_mean("CLV_Predicted").alias("MeanCLV"), median.alias("MedianCLV"),
                  F.max("CLV_Predicted").alias("MaxCLV"))


def kpi_summary(df: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("TotalCustomers"),
        exact_sum("TotalSpend").alias("TotalRevenue"),
        exact_mean("CLV_Predicted").alias("AvgCLV"),
        exact_mean("RFM_Score").alias("AvgRFM"),
        (safe_ratio(F.count_if(F.col("Segment").isin(*TOP_SEGMENTS)), n) * F.lit(100.0))
        .alias("ChampionsLoyalPct"),
    )


def chart_segment_share(df: DataFrame) -> DataFrame:
    s = segment_share(df)
    return s.select("Segment", "Customers", "Percent")


def chart_segment_rfm(seg: DataFrame) -> DataFrame:
    return seg.select("Segment", round2("Avg_RFM_Score").alias("Avg_RFM_Score"))


def chart_segment_clv(seg: DataFrame) -> DataFrame:
    return seg.select("Segment", round_to("Avg_CLV", 0).alias("Avg_CLV"))


def chart_rm_grid(df: DataFrame) -> DataFrame:
    """Customers per (R, M, segment) cell: the recency/monetary scatter as a grid."""
    return df.groupBy("R_Score", "M_Score", "Segment").agg(F.count(F.lit(1)).alias("Customers"))


def chart_revenue_tree(seg: DataFrame) -> DataFrame:
    return seg.select("Segment", "Total_Spend", "Avg_RFM_Score")


def top_customers(df: DataFrame, k: int = 100) -> DataFrame:
    order = [F.col("RFM_Score").desc(), F.col("TotalSpend").desc(), F.col("CustomerKey").asc()]
    return top_k(df, order, k).select(
        "Rank", "CustomerKey", "CustomerName", "Segment", "R_Score", "F_Score", "M_Score",
        "RFM_Score", F.col("TotalSpend").cast("double").alias("TotalSpend"), "CLV_Predicted")


def churn_risk(df: DataFrame, k: int = 10, fallback_score: float = CHURN_FALLBACK_SCORE,
               segments: Sequence[str] = CHURN_SEGMENTS) -> DataFrame:
    """Top-k customers at risk by spend; when no row is in ``segments``, customers with
    RFM_Score below ``fallback_score`` are used instead. One scan: the best k of either kind,
    at-risk rows first, of which the fallback rows count only if none is at risk."""
    at_risk = F.coalesce(F.col("Segment").isin(*segments), F.lit(False))
    either = df.where(at_risk | (F.col("RFM_Score") < F.lit(fallback_score))).withColumn("_risk", at_risk)
    order = [F.col("TotalSpend").desc(), F.col("CustomerKey").asc()]
    first = either.orderBy(F.col("_risk").desc(), *order).limit(k)
    any_risk = F.max("_risk").over(Window.partitionBy())  # over at most k rows
    chosen = first.withColumn("_any", any_risk).where(F.col("_risk") | ~F.col("_any"))
    return top_k(chosen, order, k).select(
        "Rank", "CustomerKey", "CustomerName", "Segment", "RFM_Score",
        F.col("TotalSpend").cast("double").alias("TotalSpend"), "CLV_Predicted")


# Column lists of the two report sheets.
def report_rfm_scores(df: DataFrame) -> DataFrame:
    cols = ["CustomerID", "CustomerName", "R_Score", "F_Score", "M_Score", "RFM_Score", "Segment",
            "RecencyDays", "TransactionCount", "TotalSpend"]
    return df.select([c for c in cols if c in df.columns])


def report_clv(df: DataFrame) -> DataFrame:
    cols = ["CustomerID", "CustomerName", "Segment", "AvgOrderValue", "CLV_Predicted"]
    return df.select([c for c in cols if c in df.columns])
