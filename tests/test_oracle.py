"""Every registered query against its DuckDB SQL on the smallest test scale."""

import pytest

import __spark_entry__ as entry
from data_folders import SMALL
from oracle_compare import run


@pytest.fixture(scope="module")
def results(spark):
    from clientele.plans import queries

    queries.clear_cache()
    return run(spark, SMALL, list(queries.queries()), verbose=False)


def test_all_queries_match_oracle(results):
    bad = {k: v for k, v in results.items() if not (v == "MATCH" or v.startswith("rows-only"))}
    assert not bad, bad


def test_oracle_covers_every_query():
    from clientele.plans import queries

    assert set(queries.queries()) == set(queries.oracle_sql())
    assert set(queries.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_reject_reason_occurs(spark, results):
    """The damaged rows of the feed: the comparison of rejects is not one of empty tables."""
    from clientele.plans import queries

    found = {r.RejectReason for r in queries.q_ingest_rejects(spark, SMALL).collect()}
    assert found == {"bad_date", "bad_quantity", "bad_price", "bad_amount", "unknown_customer",
                     "unknown_product", "date_not_in_calendar", "quantity_not_positive"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "Segment" in df.columns


def test_segment_counts_cover_every_customer(spark):
    from clientele.plans import queries

    seg = {r.Segment: r.Customers for r in queries.q_segment_summary(spark, SMALL).collect()}
    assert sum(seg.values()) == queries.q_rfm_results(spark, SMALL).count() == 150
    # cross-check values of FIXTURES.md section 3 (sf0.001)
    assert seg == {"Champions": 16, "Loyal Customers": 37, "Potential Loyalists": 16,
                   "Customers Needing Attention": 8, "At Risk": 8, "Hibernating": 38,
                   "New/Low Value": 27}
