"""Plan-shape checks: the plans we want at scale, not just the right answers."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001

Q = E.queries()


def plan(spark, name):
    df = Q[name](spark, SF001)
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(spark, name):
    return Q[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()


def test_category_mart_never_touches_orders(spark):
    # both left joins to order headers are removed: their columns are unused
    # and the header side is unique on the key
    p = optimized(spark, "mart_category_performance")
    assert "o_orderkey" not in p and "Join LeftOuter" not in p
    assert p.count("Aggregate") >= 2  # per product, then per category


def test_category_mart_reads_only_needed_columns(spark):
    p = plan(spark, "mart_category_performance")
    assert "ReadSchema: struct<l_partkey:bigint" in p
    for unused in ("l_orderkey", "l_quantity", "l_discount", "l_tax", "l_suppkey", "o_custkey"):
        assert unused not in p


@pytest.mark.parametrize("name", ["mart_customer_retention", "mart_channel_performance",
                                  "fct_experiment_results", "stg_order_items", "dq_rate_bounds"])
def test_no_sort_aggregate(spark, name):
    assert "SortAggregate" not in plan(spark, name)


def test_retention_does_not_count_items(spark):
    # num_of_item needs a lineitem aggregate; retention must not plan it
    assert "lineitem" not in optimized(spark, "mart_customer_retention")


def test_experiment_fact_prefilters_items(spark):
    p = optimized(spark, "fct_experiment_results")
    assert "LeftSemi" in p


@pytest.mark.parametrize("name", ["mart_category_performance", "mart_channel_performance",
                                  "mart_customer_retention", "fct_experiment_results",
                                  "variant_balance", "conversion_ztest", "aov_welch"])
def test_no_cartesian_or_unpartitioned_window(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p
    assert "SinglePartition" not in p or name in ("conversion_ztest", "aov_welch", "variant_balance")


def test_date_window_filters_before_basket_aggregate(spark):
    # the window filter sits on the per-key order header (one narrow shuffle
    # of orders); items are semi-joined to the windowed orders before the
    # basket aggregate, so no item outside the window is aggregated
    p = optimized(spark, "fct_experiment_results")
    assert "LeftSemi" in p and "1998-01-01" in p


@pytest.mark.parametrize("name", ["variant_balance", "interval_chart"])
def test_one_aggregate_serves_the_whole_query(spark, name):
    p = plan(spark, name)
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "Subquery" not in p
    assert optimized(spark, name).count("Relation [l_orderkey") == 1


@pytest.mark.parametrize("name", ["sample_size_and_duration", "experiment_decision",
                                  "headline_figures", "experiment_report_display"])
def test_one_row_aggregates_are_scalar_subqueries(spark, name):
    p = plan(spark, name)
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "Subquery" in p


def test_window_filter_reaches_scan_on_shop_tables(spark, tmp_path):
    """With shop-schema tables on disk the date window is a Parquet range filter."""
    from cartwright.plans.models import ExperimentModels, Models
    from cartwright.sources.shop import from_tables, from_tpch
    from cartwright.sources.tables import TableSource
    src = from_tpch(TableSource(spark, SF001))
    for n in ("users", "orders", "order_items", "products"):
        getattr(src, n).write.parquet(str(tmp_path / n))
    e = ExperimentModels(Models(from_tables(TableSource(spark, str(tmp_path)))))
    p = e.fct_experiment_results._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_at,1998-01-01T00:00)" in p
