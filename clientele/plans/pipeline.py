"""End-to-end job: star schema in, every report table out.

The per-customer scored table (view -> RFM -> CLV) is written once as a table and read
back by all customer reports, as the source's reports read its results table; so is the
cohort base (one fact join for all cohort tables) and the mined itemsets.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame

from clientele.operators import basket as B
from clientele.operators import cohort as C
from clientele.operators import reports as R
from clientele.operators.clv import clv
from clientele.operators.customer_view import customer_extract, customer_single_view
from clientele.operators.rfm import rfm
from clientele.session import cut_lineage
from clientele.sources.sinks import new_version, publish_version, read_table, write_table
from clientele.sources.testdata import Star

# Export column list of the results table. CohortYearMonth is listed by the
# source but never produced, so it is skipped like any other missing name.
RESULT_COLUMNS = ("CustomerKey", "CustomerID", "CustomerName", "Email", "RegistrationDate",
                  "RecencyDays", "TransactionCount", "TotalSpend", "AvgOrderValue",
                  "CustomerTenureDays", "CohortYearMonth", "PrimaryRegion", "Country", "State",
                  "R_Score", "F_Score", "M_Score", "RFM_Score", "Segment", "CLV_Predicted",
                  "LastPurchaseDate")


def materialise(df: DataFrame, path: str | None) -> DataFrame:
    """Write a table and read it back: at ``path``, else in the session's shared folder."""
    if path is None:
        return cut_lineage(df)
    write_table(df, path)
    return read_table(df.sparkSession, path)


def scored_customers(star: Star, as_of: _dt.date, path: str | None = None) -> DataFrame:
    view = customer_single_view(star.customer, star.sales(), star.product, star.region, as_of)
    return materialise(clv(rfm(customer_extract(view))), path)


def run_pipeline(star: Star, as_of: _dt.date, out_dir: str | None = None,
                 min_support: float = B.MIN_SUPPORT,
                 min_confidence: float = B.MIN_CONFIDENCE) -> dict[str, DataFrame]:
    """All output tables by name; with ``out_dir`` they are written below it as well."""
    def path(name: str) -> str | None:
        return f"{out_dir.rstrip('/')}/{name}" if out_dir else None

    scored = scored_customers(star, as_of, path("scored_customers"))
    base = materialise(C.cohort_base(star.customer, star.sales(with_region=False)), path("cohort_base"))
    seg = materialise(R.segment_summary(scored), path("segment_summary"))
    items = B.basket_items(star.sales(with_region=False), star.product)
    itemsets = B.frequent_itemsets(B.baskets(items), min_support)
    rules = cut_lineage(B.association_rules(itemsets, min_confidence))
    outputs = {
        "rfm_results": scored.select([c for c in RESULT_COLUMNS if c in scored.columns]),
        "report_rfm_scores": R.report_rfm_scores(scored),
        "report_clv": R.report_clv(scored),
        "segment_share": R.segment_share(scored),
        "score_distribution": R.score_distribution(scored),
        "rfm_stats": R.rfm_stats(scored),
        "clv_stats": R.clv_stats(scored),
        "kpi_summary": R.kpi_summary(scored),
        "chart_segment_share": R.chart_segment_share(scored),
        "chart_segment_rfm": R.chart_segment_rfm(seg),
        "chart_segment_clv": R.chart_segment_clv(seg),
        "chart_rm_grid": R.chart_rm_grid(scored),
        "chart_revenue_tree": R.chart_revenue_tree(seg),
        "top100_customers": R.top_customers(scored, 100),
        "churn_risk_top10": R.churn_risk(scored, 10),
        "cohort_summary": C.cohort_summary(base),
        "cohort_retention": C.cohort_retention(base),
        "cohort_spending": C.cohort_spending(base),
        "cohort_retention_wide": C.retention_wide(base),
        "cohort_spending_wide": C.to_wide(C.cohort_spending(base), "AvgSpend"),
        "cohort_top_revenue": C.cohort_top_revenue(base),
        "cohort_active_rate": C.cohort_active_rate(base),
        "basket_stats": B.basket_stats(items),
        "frequent_itemsets": itemsets,
        "market_basket_rules": B.rules_as_text(rules),
        "basket_top_rules": B.top_rules(rules),
    }
    if out_dir:
        for name, df in outputs.items():
            write_table(df, path(name))
    return {"scored_customers": scored, "cohort_base": base, "segment_summary": seg} | outputs


def publish_results(star: Star, as_of: _dt.date, folder: str, **options) -> str:
    """Write all output tables as a new version below ``folder`` and switch to it when the last one
    is written; returns the version (``sources.sinks.read_version`` reads it)."""
    spark = star.customer.sparkSession
    version = new_version(spark, folder)
    run_pipeline(star, as_of, f"{folder.rstrip('/')}/{version}", **options)
    publish_version(spark, folder, version)
    return version
