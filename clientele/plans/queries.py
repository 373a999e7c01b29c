"""Registered queries: each reads one testdata directory and returns a DataFrame.

Every query runs over the whole tables. Money leaves as DOUBLE (it is summed as
DECIMAL inside), counts as BIGINT, scores as INT, so results compare value for value
with the DuckDB oracle in ``clientele/plans/oracle.py``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from clientele.operators import basket as B
from clientele.operators import cohort as C
from clientele.operators import reports as R
from clientele.operators import ingest as I
from clientele.operators.calendar import calendar_for
from clientele.operators.customer_view import customer_extract, customer_single_view
from clientele.operators.ranking import global_row_number
from clientele.operators.versions import keys_at, merge_versions
from clientele.plans import oracle as O
from clientele.plans.ingest_job import FACTS, REJECTS, load_feed, warehouse_table
from clientele.plans.pipeline import RESULT_COLUMNS, scored_customers
from clientele.session import cut_lineage, ensure_checkpoint_dir
from clientele.sources.sinks import drop_table
from clientele.sources.testdata import TESTDATA_AS_OF, load_star

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def report_types(df: DataFrame) -> DataFrame:
    """Types of a registered query's result.

    DECIMAL leaves as DOUBLE (the source hands money on as float). Dates and timestamps
    leave as ISO text ('yyyy-MM-dd', 'yyyy-MM-dd HH:mm:ss'): client libraries map
    DATE to different Python types (date objects from Spark, datetime64 from DuckDB),
    and text compares the same whichever way the results are fetched. The library
    operators themselves keep DATE / TIMESTAMP.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(cols)


# ---------------------------------------------------------------- customer view

def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = load_star(spark, sf_dir)
    return customer_single_view(star.customer, star.sales(), star.product, star.region,
                                TESTDATA_AS_OF)


_SCORED: dict[tuple[str, str], DataFrame] = {}


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract -> RFM -> CLV, the enriched per-customer table of the pipeline.

    Like the source's results table, it is written once per session and data folder (as
    Parquet in the shared folder); every report below reads that table.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SCORED:
        _SCORED[key] = scored_customers(load_star(spark, sf_dir), TESTDATA_AS_OF)
    return _SCORED[key]


def clear_cache() -> None:
    for kept in (_SCORED, _MINED, _WAREHOUSES):
        kept.clear()


VIEW_COLUMNS = (f"CustomerKey, CustomerID, CustomerName, Email, Phone, {O.day('RegistrationDate')}, "
                "RecencyDays, TransactionCount, CAST(TotalSpend AS DOUBLE) AS TotalSpend, PurchaseCount, "
                "ReturnCount, AvgOrderValue, CustomerTenureDays, CohortYear, CohortQuarter, "
                f"CohortMonth, MonthsActive, PrimaryRegion, Country, State, {O.instant('LastPurchaseDate')}, "
                "CategoriesPurchased, RecencyCategory")


@register("customer_single_view", O.with_ctes(O.STAR, O.VIEW,
                                              final=f"SELECT {VIEW_COLUMNS} FROM customer_view_banded"))
def q_customer_single_view(spark, sf_dir):
    return report_types(view(spark, sf_dir))


@register("customer_extract", O.with_ctes(O.STAR, O.VIEW, final=f"SELECT {VIEW_COLUMNS} FROM extract"))
def q_customer_extract(spark, sf_dir):
    return report_types(customer_extract(view(spark, sf_dir)))


# two loads of the customer dimension: a customer's status is known from the orders before each
VERSION_DATES = (dt.date(1900, 1, 1), dt.date(1998, 1, 1))
VERSION_ATTRIBUTES = ("CustomerName", "Email", "Phone", "RegistrationDate", "LifecycleStatus")


def customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by lifecycle status (number of orders): those with orders before the second
    date as known then, and all of them as known at the end."""
    star = load_star(spark, sf_dir)
    early = F.col("o_orderdate") < F.lit(str(VERSION_DATES[1])).cast("timestamp_ntz")
    orders = star.table("orders").groupBy(F.col("o_custkey").alias("_ck")).agg(
        F.count_if(early).alias("_early"), F.count(F.lit(1)).alias("_all"))
    known = star.customer.drop("LifecycleStatus").join(orders, F.col("CustomerKey") == F.col("_ck"), "left")

    def feed(count: str) -> DataFrame:
        n = F.coalesce(F.col(count), F.lit(0))
        return known.withColumn("LifecycleStatus", F.when(n < 5, F.lit("New"))
                                .when(n < 10, F.lit("Active")).otherwise(F.lit("Loyal")))

    def load(existing, rows, day):
        return merge_versions(existing, rows, "CustomerID", "CustomerKey", VERSION_ATTRIBUTES, day)
    first = load(None, feed("_early").where(F.col("_early") > 0), VERSION_DATES[0])
    return load(first, feed("_all"), VERSION_DATES[1])


def versioned_view(spark: SparkSession, sf_dir: str,
                   versions: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The versioned dimension, and the view over it with lines keyed by the version in force
    at their date."""
    star = load_star(spark, sf_dir)
    versions = versions or cut_lineage(customer_versions(spark, sf_dir))
    ids = star.customer.select("CustomerKey", "CustomerID")
    lines = star.sales().join(ids, "CustomerKey").drop("CustomerKey")
    lines = keys_at(lines, versions, "CustomerID", "CustomerKey", "TransactionDate")
    return versions, customer_single_view(versions, lines, star.product, star.region, TESTDATA_AS_OF)


@register("customer_versions", O.with_ctes(O.STAR, O.VERSIONS, final=f"""
    SELECT CustomerKey, CustomerID, LifecycleStatus, {O.day('RegistrationDate')}, {O.day('ValidFrom')},
           {O.day('ValidTo')}, IsCurrentRecord FROM customer_versions"""))
def q_customer_versions(spark, sf_dir):
    return report_types(customer_versions(spark, sf_dir).select(
        "CustomerKey", "CustomerID", "LifecycleStatus", "RegistrationDate", "ValidFrom", "ValidTo",
        "IsCurrentRecord"))


@register("customer_view_versions", O.with_ctes(O.STAR, O.VERSIONS, O.VERSIONED_VIEW,
                                                final=f"SELECT {VIEW_COLUMNS} FROM customer_view_banded"))
def q_customer_view_versions(spark, sf_dir):
    """The single view over a dimension that does hold closed versions: their lines do not count."""
    return report_types(versioned_view(spark, sf_dir)[1])


# ---------------------------------------------------------------- ranking, RFM, CLV

@register("global_rank", O.with_ctes(O.STAR, O.VIEW, final="""
    SELECT CustomerKey, CAST(TotalSpend AS DOUBLE) AS TotalSpend,
           row_number() OVER (ORDER BY TotalSpend, CustomerKey) AS SpendRank
    FROM extract"""))
def q_global_rank(spark, sf_dir):
    ext = customer_extract(view(spark, sf_dir)).select("CustomerKey", "TotalSpend")
    ranked = global_row_number(ext, [F.col("TotalSpend").asc(), F.col("CustomerKey").asc()],
                               rank_col="SpendRank")
    return report_types(ranked.select("CustomerKey", "TotalSpend", "SpendRank"))


@register("rfm_scores", O.base("SELECT CustomerKey, R_Score, F_Score, M_Score FROM results"))
def q_rfm_scores(spark, sf_dir):
    return scored(spark, sf_dir).select("CustomerKey", "R_Score", "F_Score", "M_Score")


@register("rfm_segments", O.base(
    "SELECT CustomerKey, R_Score, F_Score, M_Score, RFM_Score, Segment FROM results"))
def q_rfm_segments(spark, sf_dir):
    return scored(spark, sf_dir).select("CustomerKey", "R_Score", "F_Score", "M_Score",
                                        "RFM_Score", "Segment")


@register("clv", O.base("""
    SELECT CustomerKey, AvgOrderValue, PurchaseCount, CustomerTenureDays, AnnualRevenue,
           CLV_Predicted FROM results"""))
def q_clv(spark, sf_dir):
    return scored(spark, sf_dir).select("CustomerKey", "AvgOrderValue", "PurchaseCount",
                                        "CustomerTenureDays", "AnnualRevenue", "CLV_Predicted")




def present_columns(df: DataFrame, wanted) -> DataFrame:
    return df.select([c for c in wanted if c in df.columns])


@register("rfm_results", O.base(f"""
    SELECT CustomerKey, CustomerID, CustomerName, Email, {O.day('RegistrationDate')}, RecencyDays,
           TransactionCount, CAST(TotalSpend AS DOUBLE) AS TotalSpend, AvgOrderValue,
           CustomerTenureDays, PrimaryRegion, Country, State, R_Score, F_Score, M_Score,
           RFM_Score, Segment, CLV_Predicted, {O.instant('LastPurchaseDate')}
    FROM results"""))
def q_rfm_results(spark, sf_dir):
    return report_types(present_columns(scored(spark, sf_dir), RESULT_COLUMNS))


# ---------------------------------------------------------------- reports

def seg(spark, sf_dir):
    return R.segment_summary(scored(spark, sf_dir))


SEGMENT_SQL = f"""
    SELECT Segment, count(CustomerID) AS Customers, {O.exact_mean('RFM_Score')} AS Avg_RFM_Score,
           CAST(sum(TotalSpend) AS DOUBLE) AS Total_Spend, {O.exact_mean('CLV_Predicted')} AS Avg_CLV
    FROM results GROUP BY Segment"""


@register("segment_summary", O.base(SEGMENT_SQL))
def q_segment_summary(spark, sf_dir):
    return seg(spark, sf_dir)


@register("segment_share", O.base(f"""
    SELECT Segment, count(*) AS Customers, {O.ratio('sum(TotalSpend)', 'count(TotalSpend)')} AS AvgSpend,
           {O.ratio('count(*)', '(SELECT count(*) FROM results)')} * CAST(100 AS DOUBLE) AS Percent
    FROM results GROUP BY Segment"""))
def q_segment_share(spark, sf_dir):
    return R.segment_share(scored(spark, sf_dir))


@register("score_distribution", O.base("""
    SELECT 'R' AS Dimension, R_Score AS Score, count(*) AS Customers FROM results GROUP BY R_Score
    UNION ALL SELECT 'F', F_Score, count(*) FROM results GROUP BY F_Score
    UNION ALL SELECT 'M', M_Score, count(*) FROM results GROUP BY M_Score"""))
def q_score_distribution(spark, sf_dir):
    return R.score_distribution(scored(spark, sf_dir))


@register("rfm_stats", O.base(f"""
    SELECT {O.exact_mean('RFM_Score')} AS MeanRFM, min(RFM_Score) AS MinRFM, max(RFM_Score) AS MaxRFM
    FROM results"""))
def q_rfm_stats(spark, sf_dir):
    return R.rfm_stats(scored(spark, sf_dir))


@register("clv_stats", O.base(f"""
    SELECT {O.exact_mean('CLV_Predicted')} AS MeanCLV,
           (SELECT (min(v) + max(v)) / CAST(2 AS DOUBLE) FROM (
               SELECT CLV_Predicted AS v,
                      row_number() OVER (ORDER BY CLV_Predicted, CustomerKey) AS pos,
                      count(*) OVER () AS cnt
               FROM results WHERE CLV_Predicted IS NOT NULL)
            WHERE pos = floor((cnt + 1) / 2) OR pos = ceil((cnt + 1) / 2)) AS MedianCLV,
           max(CLV_Predicted) AS MaxCLV
    FROM results"""))
def q_clv_stats(spark, sf_dir):
    return R.clv_stats(scored(spark, sf_dir))


@register("kpi_summary", O.base(f"""
    SELECT count(*) AS TotalCustomers, CAST(sum(TotalSpend) AS DOUBLE) AS TotalRevenue,
           {O.exact_mean('CLV_Predicted')} AS AvgCLV, {O.exact_mean('RFM_Score')} AS AvgRFM,
           {O.ratio("count(*) FILTER (WHERE Segment IN ('Champions', 'Loyal Customers'))", 'count(*)')}
               * CAST(100 AS DOUBLE) AS ChampionsLoyalPct
    FROM results"""))
def q_kpi_summary(spark, sf_dir):
    return R.kpi_summary(scored(spark, sf_dir))


@register("chart_segment_share", O.base(f"""
    SELECT Segment, count(*) AS Customers,
           {O.ratio('count(*)', '(SELECT count(*) FROM results)')} * CAST(100 AS DOUBLE) AS Percent
    FROM results GROUP BY Segment"""))
def q_chart_segment_share(spark, sf_dir):
    return R.chart_segment_share(scored(spark, sf_dir))


@register("chart_segment_rfm", O.base(
    f"SELECT Segment, {O.round2('Avg_RFM_Score')} AS Avg_RFM_Score FROM seg",
    {"seg": SEGMENT_SQL}))
def q_chart_segment_rfm(spark, sf_dir):
    return R.chart_segment_rfm(seg(spark, sf_dir))


@register("chart_segment_clv", O.base(
    "SELECT Segment, round_even(Avg_CLV, 0) AS Avg_CLV FROM seg", {"seg": SEGMENT_SQL}))
def q_chart_segment_clv(spark, sf_dir):
    return R.chart_segment_clv(seg(spark, sf_dir))


@register("chart_rm_grid", O.base(
    "SELECT R_Score, M_Score, Segment, count(*) AS Customers FROM results GROUP BY R_Score, M_Score, Segment"))
def q_chart_rm_grid(spark, sf_dir):
    return R.chart_rm_grid(scored(spark, sf_dir))


@register("chart_revenue_tree", O.base(
    "SELECT Segment, Total_Spend, Avg_RFM_Score FROM seg", {"seg": SEGMENT_SQL}))
def q_chart_revenue_tree(spark, sf_dir):
    return R.chart_revenue_tree(seg(spark, sf_dir))


@register("top100_customers", O.base("""
    SELECT * FROM (
        SELECT row_number() OVER (ORDER BY RFM_Score DESC, TotalSpend DESC, CustomerKey) AS Rank,
               CustomerKey, CustomerName, Segment, R_Score, F_Score, M_Score, RFM_Score,
               CAST(TotalSpend AS DOUBLE) AS TotalSpend, CLV_Predicted
        FROM results) WHERE Rank <= 100"""))
def q_top100_customers(spark, sf_dir):
    return R.top_customers(scored(spark, sf_dir), 100)


def _churn_sql(source: str) -> str:
    return f"""
    SELECT * FROM (
        SELECT row_number() OVER (ORDER BY TotalSpend DESC, CustomerKey) AS Rank,
               CustomerKey, CustomerName, Segment, RFM_Score, CAST(TotalSpend AS DOUBLE) AS TotalSpend,
               CLV_Predicted
        FROM {source}
        WHERE Segment IN ('At Risk', 'Hibernating')
           OR ((SELECT count(*) FROM {source} WHERE Segment IN ('At Risk', 'Hibernating')) = 0
               AND RFM_Score < CAST(2.5 AS DOUBLE)))
    WHERE Rank <= 10"""


@register("churn_risk_top10", O.base(_churn_sql("results")))
def q_churn_risk_top10(spark, sf_dir):
    return R.churn_risk(scored(spark, sf_dir), 10)


@register("churn_risk_fallback", O.base(
    _churn_sql("others"),
    {"others": "SELECT * FROM results WHERE Segment NOT IN ('At Risk', 'Hibernating')"}))
def q_churn_risk_fallback(spark, sf_dir):
    """The same report on customers outside the churn segments: exercises the fallback."""
    others = scored(spark, sf_dir).where(~F.col("Segment").isin("At Risk", "Hibernating"))
    return R.churn_risk(others, 10)


@register("report_rfm_scores", O.base("""
    SELECT CustomerID, CustomerName, R_Score, F_Score, M_Score, RFM_Score, Segment, RecencyDays,
           TransactionCount, CAST(TotalSpend AS DOUBLE) AS TotalSpend FROM results"""))
def q_report_rfm_scores(spark, sf_dir):
    return report_types(R.report_rfm_scores(scored(spark, sf_dir)))


@register("report_clv", O.base(
    "SELECT CustomerID, CustomerName, Segment, AvgOrderValue, CLV_Predicted FROM results"))
def q_report_clv(spark, sf_dir):
    return R.report_clv(scored(spark, sf_dir))


# ---------------------------------------------------------------- cohorts

def cohort_base_df(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return C.cohort_base(star.customer, star.sales(with_region=False))


@register("cohort_base", O.cohort(f"""
    SELECT CustomerKey, CustomerID, {O.day('RegistrationDate')}, CohortYear, CohortQuarter, CohortMonth,
           {O.instant('LastPurchaseDate')}, TransactionCount, CAST(TotalSpend AS DOUBLE) AS TotalSpend,
           MonthsSinceCohort
    FROM cohort_base"""))
def q_cohort_base(spark, sf_dir):
    return report_types(cohort_base_df(spark, sf_dir))


@register("cohort_summary", O.cohort(f"""
    SELECT CohortMonth AS Cohort, count(CustomerKey) AS CohortSize,
           {O.round2('CAST(sum(TotalSpend) AS DOUBLE)')} AS TotalRevenue,
           {O.round2(O.ratio('sum(TotalSpend)', 'count(TotalSpend)'))} AS AvgSpend,
           {O.round2(O.ratio('sum(TransactionCount)', 'count(TransactionCount)'))} AS AvgTransactions
    FROM cohort_base GROUP BY CohortMonth"""))
def q_cohort_summary(spark, sf_dir):
    return C.cohort_summary(cohort_base_df(spark, sf_dir))


@register("cohort_retention", O.cohort(f"""
    SELECT Cohort, MonthsSinceCohort, Customers, Denominator,
           {O.ratio('Customers', 'Denominator')} * CAST(100 AS DOUBLE) AS RetentionPct
    FROM (SELECT c.*, COALESCE(max(CASE WHEN c.MonthsSinceCohort =
                     (SELECT min(MonthsSinceCohort) FROM cohort_cells) THEN c.Customers END)
                  OVER (PARTITION BY c.Cohort), 0) AS Denominator
          FROM cohort_cells c)"""))
def q_cohort_retention(spark, sf_dir):
    return C.cohort_retention(cohort_base_df(spark, sf_dir), "first_offset")


@register("cohort_retention_by_size", O.cohort(f"""
    SELECT c.Cohort, c.MonthsSinceCohort, c.Customers, s.Denominator,
           {O.ratio('c.Customers', 's.Denominator')} * CAST(100 AS DOUBLE) AS RetentionPct
    FROM cohort_cells c
    JOIN (SELECT CohortMonth AS Cohort, count(CustomerKey) AS Denominator FROM cohort_base
          GROUP BY CohortMonth) s ON c.Cohort = s.Cohort"""))
def q_cohort_retention_by_size(spark, sf_dir):
    return C.cohort_retention(cohort_base_df(spark, sf_dir), "cohort_size")


@register("cohort_spending", O.cohort(f"""
    SELECT CohortMonth AS Cohort, MonthsSinceCohort,
           {O.ratio('sum(TotalSpend)', 'count(TotalSpend)')} AS AvgSpend
    FROM cohort_base WHERE MonthsSinceCohort IS NOT NULL GROUP BY CohortMonth, MonthsSinceCohort"""))
def q_cohort_spending(spark, sf_dir):
    return C.cohort_spending(cohort_base_df(spark, sf_dir))


@register("cohort_top_revenue", O.cohort("""
    SELECT * FROM (
        SELECT Cohort, TotalRevenue, row_number() OVER (ORDER BY TotalRevenue DESC, Cohort) AS Rank
        FROM (SELECT CohortMonth AS Cohort, CAST(sum(TotalSpend) AS DOUBLE) AS TotalRevenue
              FROM cohort_base GROUP BY CohortMonth))
    WHERE Rank <= 5"""))
def q_cohort_top_revenue(spark, sf_dir):
    return C.cohort_top_revenue(cohort_base_df(spark, sf_dir), 5)


@register("cohort_active_rate", O.cohort(f"""
    SELECT * FROM (
        SELECT Cohort, ActiveRate, row_number() OVER (ORDER BY ActiveRate DESC, Cohort) AS Rank
        FROM (SELECT CohortMonth AS Cohort,
                     {O.ratio('count(*) FILTER (WHERE TransactionCount > 0)', 'count(*)')}
                         * CAST(100 AS DOUBLE) AS ActiveRate
              FROM cohort_base GROUP BY CohortMonth))
    WHERE Rank <= 5"""))
def q_cohort_active_rate(spark, sf_dir):
    return C.cohort_active_rate(cohort_base_df(spark, sf_dir), 5)


@register("cohort_retention_wide", O.cohort_matrix("retention_vals", "RetentionPct"))
def q_cohort_retention_wide(spark, sf_dir):
    """The pivoted matrix, given cell by cell over its full grid (zeros included)."""
    return C.to_long(C.retention_wide(cohort_base_df(spark, sf_dir)), "RetentionPct")


@register("cohort_spending_wide", O.cohort_matrix("spending_vals", "AvgSpend"))
def q_cohort_spending_wide(spark, sf_dir):
    wide = C.to_wide(C.cohort_spending(cohort_base_df(spark, sf_dir)), "AvgSpend")
    return C.to_long(wide, "AvgSpend")


# ---------------------------------------------------------------- market basket

def items_df(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return B.basket_items(star.sales(with_region=False), star.product)


@register("basket_items", O.basket("SELECT OrderNumber, ProductName, Category FROM bitems"))
def q_basket_items(spark, sf_dir):
    return items_df(spark, sf_dir)


@register("baskets", O.basket("""
    SELECT OrderNumber, array_to_string(items, ', ') AS Items, CAST(len(items) AS INTEGER) AS ItemCount
    FROM bsk"""))
def q_baskets(spark, sf_dir):
    b = B.baskets(items_df(spark, sf_dir))
    return b.select("OrderNumber", F.array_join("items", ", ").alias("Items"),
                    F.size("items").alias("ItemCount"))


@register("basket_stats", O.basket("""
    SELECT count(*) AS Lines, count(DISTINCT OrderNumber) AS Orders,
           CAST(count(*) AS DOUBLE) / CAST(count(DISTINCT OrderNumber) AS DOUBLE) AS AvgLinesPerOrder,
           count(DISTINCT ProductName) AS DistinctItems
    FROM bitems"""))
def q_basket_stats(spark, sf_dir):
    return B.basket_stats(items_df(spark, sf_dir))


_MINED: dict[tuple[str, str], DataFrame] = {}


def itemsets_df(spark, sf_dir):
    """The mined itemsets, written once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MINED:
        _MINED[key] = B.frequent_itemsets(B.baskets(items_df(spark, sf_dir)), B.MIN_SUPPORT)
    return _MINED[key]


@register("frequent_itemsets", O.basket("""
    SELECT array_to_string(itemset, ', ') AS Itemset, Length, Count, support FROM itemsets"""))
def q_frequent_itemsets(spark, sf_dir):
    fi = itemsets_df(spark, sf_dir)
    return fi.select(F.array_join("items", ", ").alias("Itemset"), "Length", "Count", "support")


@register("basket_rules", O.basket("SELECT * FROM rules"))
def q_basket_rules(spark, sf_dir):
    return B.rules_as_text(B.association_rules(itemsets_df(spark, sf_dir), B.MIN_CONFIDENCE))


@register("basket_top_rules", O.basket("""
    SELECT * FROM (SELECT *, row_number() OVER (ORDER BY lift DESC, antecedents, consequents) AS Rank
                   FROM rules) WHERE Rank <= 10"""))
def q_basket_top_rules(spark, sf_dir):
    return B.top_rules(B.association_rules(itemsets_df(spark, sf_dir), B.MIN_CONFIDENCE), 10)



# ---------------------------------------------------------------- ingest, calendar, counts

INGEST_SPLIT = "1998-01-01"  # the feed is loaded as two batches: before / from this date


_WAREHOUSES: dict[tuple[str, str], str] = {}


def warehouse(spark, sf_dir) -> str:
    """A warehouse folder into which the feed was loaded as two batches (before / from
    ``INGEST_SPLIT``), once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        star = load_star(spark, sf_dir)
        folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warehouse/{uuid.uuid4().hex}"
        day = I.parse_timestamp(F.col("Date"))
        early = F.coalesce(day < F.lit(INGEST_SPLIT).cast("timestamp"), F.lit(False))
        feed = cut_lineage(star.feed().withColumn("_early", early))
        calendar = cut_lineage(order_calendar(star))
        for batch in (feed.where("_early"), feed.where("NOT _early")):
            load_feed(batch, folder, calendar, TESTDATA_AS_OF, staged=True)
        _WAREHOUSES[key] = folder
    return _WAREHOUSES[key]


def order_calendar(star) -> DataFrame:
    return calendar_for(star.table("orders").select(F.to_date("o_orderdate").alias("d")), "d")


@register("ingest_transform", O.ingest(f"SELECT * REPLACE ({O.instant('OrderDate')}) FROM tx"))
def q_ingest_transform(spark, sf_dir):
    return report_types(I.ingest_transform(load_star(spark, sf_dir).feed()))


@register("ingest_csv", O.ingest(f"SELECT * REPLACE ({O.instant('OrderDate')}) FROM tx"))
def q_ingest_csv(spark, sf_dir):
    """The raw feed as a headered CSV file (written by Spark from the given tables into
    the session's checkpoint folder), read back with the CSV reader and transformed."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/feeds/{uuid.uuid4().hex}"
    load_star(spark, sf_dir).feed().write.option("header", True).csv(folder)
    read = cut_lineage(I.ingest_transform(I.read_transactions(spark, folder)))
    drop_table(spark, folder)
    return report_types(read)


@register("ingest_dim_product", O.ingest("SELECT * FROM products"))
def q_ingest_dim_product(spark, sf_dir):
    products = warehouse_table(spark, warehouse(spark, sf_dir), "dim_product")
    return products.select("ProductKey", "ProductID", "ProductName", "Category")


@register("ingest_dim_customer", O.ingest("SELECT * FROM customers"))
def q_ingest_dim_customer(spark, sf_dir):
    customers = warehouse_table(spark, warehouse(spark, sf_dir), "dim_customer")
    return customers.select("CustomerKey", "CustomerID", "CustomerName", "Email")


@register("ingest_fact_sales", O.ingest(
    f"SELECT * REPLACE ({O.instant('TransactionDate')}) FROM (SELECT * FROM f1 UNION ALL SELECT * FROM f2)",
    facts=True))
def q_ingest_fact_sales(spark, sf_dir):
    f = warehouse_table(spark, warehouse(spark, sf_dir), FACTS)
    return report_types(f.select("SalesID", "CustomerKey", "ProductKey", "DateKey", "RegionKey",
                                 "OrderNumber", "TransactionDate", "Quantity", "UnitPrice",
                                 "SalesAmount", "NetSalesAmount"))


@register("ingest_rejects", O.ingest("""
    SELECT OrderID, CustomerID, ProductID, RejectReason FROM k1 WHERE RejectReason IS NOT NULL
    UNION ALL
    SELECT OrderID, CustomerID, ProductID, RejectReason FROM k2 WHERE RejectReason IS NOT NULL""",
    facts=True))
def q_ingest_rejects(spark, sf_dir):
    rejects = warehouse_table(spark, warehouse(spark, sf_dir), REJECTS)
    return rejects.select("OrderID", "CustomerID", "ProductID", "RejectReason")


def write_lines(lines: DataFrame, path: str) -> None:
    """CSV lines (one text column) as they are, with the feed's header, beside what ``path`` holds."""
    header = ",".join(I.RAW_COLUMNS)
    (lines.toDF(header).write.mode("append").option("header", True)
     .option("sep", "\u0001").option("quote", "").csv(path))


@register("ingest_bad_lines", O.ingest(O.BAD_LINES, {"bad": O.BAD, "kb": O.classified_by_key("tx")}))
def q_ingest_bad_lines(spark, sf_dir):
    """Rejects of the feed loaded from CSV files that also hold lines with too few and too many
    fields (made of the given order lines): such a line is kept whole, all others as before."""
    star = load_star(spark, sf_dir)
    shared = f"{ensure_checkpoint_dir(spark).rstrip('/')}/feeds/{uuid.uuid4().hex}"
    star.feed().write.option("header", True).csv(shared)
    write_lines(star.malformed_lines(), shared)
    folder = f"{shared}-warehouse"
    load_feed(I.read_feed(spark, shared), folder, cut_lineage(order_calendar(star)), TESTDATA_AS_OF)
    drop_table(spark, shared)
    rejects = warehouse_table(spark, folder, REJECTS)
    return rejects.select("OrderID", "CustomerID", "ProductID", "RejectReason", I.BAD_LINE)


@register("dim_date", f"SELECT * REPLACE ({O.day('CalendarDate')}) FROM ({O.CALENDAR})")
def q_dim_date(spark, sf_dir):
    return report_types(order_calendar(load_star(spark, sf_dir)))


@register("table_row_counts", O.with_ctes(O.STAR, final="""
    SELECT 'Dim_Region' AS Table_Name, count(*) AS Row_Count FROM dim_region
    UNION ALL SELECT 'Dim_Product', count(*) FROM dim_product
    UNION ALL SELECT 'Dim_Customer', count(*) FROM dim_customer
    UNION ALL SELECT 'Fact_Sales', count(*) FROM fact_sales"""))
def q_table_row_counts(spark, sf_dir):
    star = load_star(spark, sf_dir)
    parts = [("Dim_Region", star.region), ("Dim_Product", star.product),
             ("Dim_Customer", star.customer), ("Fact_Sales", star.sales())]
    counted = [df.agg(F.count(F.lit(1)).alias("Row_Count")).select(
        F.lit(name).alias("Table_Name"), "Row_Count") for name, df in parts]
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out


def queries() -> dict[str, QueryFn]:
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}
