"""Whole-table properties on the driver's data (sf0.001)."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from cartwright.plans.queries import models_for
from cartwright.sources.sinks import write_table
from tests.conftest import SF001

Q = E.queries()


def test_retention_sums_to_distinct_buyers(spark):
    m, _ = models_for(spark, SF001)
    total = Q["mart_customer_retention"](spark, SF001).agg(F.sum("new_customers")).first()[0]
    buyers = (m.dim_orders.where(F.col("status") != "Cancelled")
              .select("user_id").distinct().count())
    assert total == buyers


def test_category_sums_equal_item_totals(spark):
    m, _ = models_for(spark, SF001)
    cat = Q["mart_category_performance"](spark, SF001).agg(
        F.sum("items_ordered"), F.sum("items_returned")).first()
    items = m.fct_order_items.join(m.dim_products.select("product_id"), "product_id")
    assert cat[0] == items.count()
    assert cat[1] == items.where(F.col("returned_at").isNotNull()).count()


def test_conversion_and_return_are_complements(spark):
    s = Q["variant_summary"](spark, SF001).collect()
    for r in s:
        assert abs(r.conversion_rate + r.return_rate - 1) < 1e-6


def test_channel_customers_equal_users(spark):
    m, _ = models_for(spark, SF001)
    n = Q["mart_channel_performance"](spark, SF001).agg(F.sum("customers")).first()[0]
    assert n == m.dim_users.count()


def test_dq_suite_passes_on_driver_data(spark):
    rows = Q["dq_results"](spark, SF001).collect()
    # 37 of the shop models, 15 of the experiment, the rate bounds
    assert len(rows) == 53
    assert all(r.passed for r in rows), [r for r in rows if not r.passed]


def test_table_sink_roundtrip_and_preview(spark, tmp_path):
    df = Q["mart_channel_performance"](spark, SF001)
    back = write_table(df, str(tmp_path / "mart_channel_performance"))
    assert sorted(back.collect()) == sorted(df.collect())
    assert len(Q["fct_experiment_results"](spark, SF001).limit(5).collect()) == 5


def test_calendar_covers_whole_years(spark):
    d = Q["date_dimension"](spark, SF001)
    r = d.agg(F.min("date"), F.max("date"), F.count("*")).first()
    assert (r[0].month, r[0].day, r[1].month, r[1].day) == (1, 1, 12, 31)
    assert d.select("quarter").distinct().count() == 4
