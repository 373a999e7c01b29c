"""Physical plan properties that matter at scale."""

import re

from data_folders import SMALL

from clientele.plans import queries


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_anywhere(spark):
    for name, fn in queries.queries().items():
        plan = plan_of(fn(spark, SMALL))
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name


def test_fact_scan_prunes_columns_and_pushes_filters(spark):
    from clientele.plans.queries import view

    text = view(spark, SMALL)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    scan = [blk for blk in text.split("\n\n") if "lineitem.parquet" in blk][0]
    assert "l_shipdate" not in scan and "l_comment" not in scan
    assert "PushedFilters" in scan


def test_customer_aggregate_is_partial_before_shuffle(spark):
    from clientele.plans.queries import view

    plan = plan_of(view(spark, SMALL))
    assert "partial_" in plan


def test_customer_view_uses_hash_aggregates_only(spark):
    plan = plan_of(queries.view(spark, SMALL))
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert "HashAggregate" in plan


def executed(df) -> str:
    """The whole plan after it ran, with the stages as they were."""
    df.write.format("noop").mode("overwrite").save()
    return plan_of(df)


def test_no_single_partition_over_customers(spark):
    """Rankings, scores and medians never gather customers in one task: one-partition
    exchanges stand over partial aggregates, dimensions or aggregated cells only."""
    from clientele.operators import ranking

    view = queries.view(spark, SMALL)
    scored = queries.scored(spark, SMALL)
    customers = scored.count()
    assert customers < 100_000                 # a size where a switch would have hidden the plan
    ranked = ranking.global_row_number(scored, [scored["CustomerKey"].asc()])
    assert "SinglePartition" not in plan_of(scored)
    # the running sum over the sizes of the ranges: one row per range
    lines = plan_of(ranked).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "_rank_size" in lines[i + 1] and "HashAggregate" in lines[i + 1], lines[i + 1]
    single = [x for x in plan_of(view).split("Exchange ") if x.startswith("SinglePartition")]
    for below in single:                       # the coded dimensions of the view
        assert not re.search(r"lineitem|customer\.parquet", below.split("\n")[1])


def test_dimension_feed_is_not_sorted(spark):
    """New keys come from a hash aggregate over the feed, not from sorting it."""
    from clientele.sources.testdata import load_star
    from clientele.operators import ingest as I

    tx = I.ingest_transform(load_star(spark, SMALL).feed())
    spellings = tx.select("ProductID", "ProductName", "Category").distinct()
    plan = plan_of(spellings)
    assert "HashAggregate" in plan and "SortAggregate" not in plan
