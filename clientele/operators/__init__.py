"""DataFrame operators of the retail customer-analytics jobs (all lazy, DataFrame in/out)."""

from clientele.operators.basket import (association_rules, basket_items, basket_stats, baskets,
                                        frequent_itemsets, rules_as_text, top_rules)
from clientele.operators.calendar import calendar_for, calendar_rows, dim_date
from clientele.operators.clv import clv
from clientele.operators.cohort import (cohort_active_rate, cohort_base, cohort_retention,
                                        cohort_spending, cohort_summary, cohort_top_revenue,
                                        retention_wide, to_wide)
from clientele.operators.customer_view import customer_extract, customer_single_view
from clientele.operators.ingest import (classify_facts, customer_rows, ingest_transform,
                                        load_facts, product_rows, read_feed, read_transactions, region_rows,
                                        rejects, upsert_dim)
from clientele.operators.ranking import global_row_number, top_k
from clientele.operators.reports import (chart_revenue_tree, chart_rm_grid, chart_segment_clv,
                                         chart_segment_rfm, chart_segment_share, churn_risk,
                                         clv_stats, exact_median, kpi_summary, report_clv,
                                         report_rfm_scores, rfm_stats, score_distribution,
                                         segment_share, segment_summary, top_customers)
from clientele.operators.rfm import rfm, rfm_index, rfm_scores, rfm_segments
from clientele.operators.versions import keys_at, merge_versions

__all__ = [name for name in dir() if not name.startswith("_")]
