"""Hand-written fixtures for the behaviours the driver's data cannot reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwright.operators import analytics, charts, experiment, marts, quality, staging, statistics
from cartwright.operators.experiment import ExperimentConfig

TS = dt.datetime

ITEMS_SCHEMA = ("order_item_id string, order_id bigint, user_id bigint, product_id bigint, "
                "status string, created_at timestamp_ntz, shipped_at timestamp_ntz, "
                "delivered_at timestamp_ntz, returned_at timestamp_ntz, sale_price double")
ORDERS_SCHEMA = ("order_id bigint, user_id bigint, status string, gender string, "
                 "created_at timestamp_ntz, returned_at timestamp_ntz, shipped_at timestamp_ntz, "
                 "delivered_at timestamp_ntz, num_of_item bigint")
PRODUCTS_SCHEMA = ("product_id bigint, product_name string, brand string, category string, "
                   "department string, cost double, retail_price double")
USERS_SCHEMA = ("user_id bigint, first_name string, last_name string, age bigint, gender string, "
                "city string, state string, country string, traffic_source string, "
                "user_created_at timestamp_ntz")


def item(i, order, user, product, status, price, returned=None, created=TS(2024, 1, 5)):
    return (f"i{i}", order, user, product, status, created, None, None, returned, price)


def order(oid, user, status, created=TS(2024, 1, 5), n=1):
    return (oid, user, status, "F", created, None, None, None, n)


def product(pid, category, cost, dept="Men"):
    return (pid, f"p{pid}", "b", category, dept, cost, None if cost is None else cost * 2)


def user(uid, source):
    return (uid, "a", "b", 30, "F", "c", "s", "x", source, TS(2020, 1, 1))


def test_null_status_is_sold_in_category_but_dropped_in_channel(spark):
    items = spark.createDataFrame([
        item(1, 1, 10, 100, None, 50.0),
        item(2, 1, 10, 100, "Complete", 30.0),
        item(3, 2, 10, 100, "Complete", 20.0),
    ], ITEMS_SCHEMA)
    prods = spark.createDataFrame([product(100, "Jeans", 10.0)], PRODUCTS_SCHEMA)
    cat = analytics.mart_category_performance(items, prods).collect()[0]
    assert cat.items_sold == 3 and cat.gross_revenue == 100.0 and cat.cost_of_goods == 30.0
    users = spark.createDataFrame([user(10, "Search")], USERS_SCHEMA)
    ch = analytics.mart_channel_performance(users, items).collect()[0]
    # the NULL-status item is excluded by status != 'Cancelled'
    assert ch.total_orders == 2 and ch.total_revenue == 50.0


def test_only_cancelled_category_gives_null_ratios(spark):
    items = spark.createDataFrame([item(1, 1, 10, 100, "Cancelled", 50.0)], ITEMS_SCHEMA)
    prods = spark.createDataFrame([product(100, "Socks", 10.0)], PRODUCTS_SCHEMA)
    r = analytics.mart_category_performance(items, prods).collect()[0]
    assert (r.items_ordered, r.items_sold, r.gross_revenue, r.gross_margin) == (1, 0, 0.0, 0.0)
    assert r.gross_margin_pct is None and r.return_rate is None


def test_cancelled_item_with_return_counts_and_bounds_report_it(spark):
    items = spark.createDataFrame([
        item(1, 1, 10, 100, "Cancelled", 50.0, returned=TS(2024, 2, 1)),
        item(2, 1, 10, 100, "Cancelled", 50.0, returned=TS(2024, 2, 1)),
        item(3, 2, 10, 100, "Returned", 20.0, returned=TS(2024, 2, 1)),
    ], ITEMS_SCHEMA)
    prods = spark.createDataFrame([product(100, "Shorts", 5.0)], PRODUCTS_SCHEMA)
    cat = analytics.mart_category_performance(items, prods)
    r = cat.collect()[0]
    assert r.items_returned == 3 and r.items_sold == 1 and r.return_rate == 3.0
    empty_ret = spark.createDataFrame([], "cohort_month date, repeat_purchase_rate double")
    empty_ch = spark.createDataFrame([], "traffic_source string, repeat_purchase_rate double")
    bad = quality.rate_bounds(cat, empty_ret, empty_ch).collect()
    assert [(b.failing_metric, b.grain, b.value) for b in bad] == [("category return_rate", "Shorts", 3.0)]


def test_null_cost_and_price_follow_sql_sum_rules(spark):
    # pre-aggregation per product must reproduce item-level NULL handling
    items = spark.createDataFrame([
        item(1, 1, 10, 100, "Complete", None),
        item(2, 1, 10, 100, "Complete", 40.0),
        item(3, 1, 10, 200, "Complete", 10.0),
        item(4, 1, 10, 200, "Cancelled", 10.0),
        item(5, 1, 10, 300, "Complete", None),
    ], ITEMS_SCHEMA)
    prods = spark.createDataFrame([product(100, "A", 5.0), product(200, "A", None),
                                   product(300, "A", 1.0)], PRODUCTS_SCHEMA)
    r = analytics.mart_category_performance(items, prods).collect()[0]
    # item-level: revenue = 40 + 10 (+0 for the cancelled one); cogs = 5 + 5 + NULL + 0 + 1
    assert r.gross_revenue == 50.0
    assert r.cost_of_goods == 11.0
    # margin = (40 - 5) + NULL + NULL + 0 + NULL
    assert r.gross_margin == 35.0
    assert r.gross_margin_pct == round(35.0 / 50.0, 4)


def test_user_without_items_counts_zero(spark):
    users = spark.createDataFrame([user(1, "Email"), user(2, "Email")], USERS_SCHEMA)
    items = spark.createDataFrame([item(1, 1, 1, 100, "Complete", 10.0),
                                   item(2, 2, 1, 100, "Complete", 10.0)], ITEMS_SCHEMA)
    r = analytics.mart_channel_performance(users, items).collect()[0]
    assert (r.customers, r.total_orders, r.total_revenue) == (2, 2, 20.0)
    assert r.repeat_purchase_rate == 0.5 and r.orders_per_customer == 1.0


def test_inclusive_date_window(spark):
    cfg = ExperimentConfig(start=dt.date(2024, 1, 1), end=dt.date(2024, 1, 28))
    orders = spark.createDataFrame([
        order(1, 10, "Complete", TS(2024, 1, 28, 23, 59, 59)),
        order(2, 10, "Complete", TS(2024, 1, 29, 0, 0, 0)),
        order(3, 10, "Complete", TS(2024, 1, 1, 0, 0, 0)),
        order(4, 10, "Shipped", TS(2024, 1, 10)),
    ], ORDERS_SCHEMA)
    items = spark.createDataFrame([item(i, i, 10, 1, "Complete", 5.0) for i in (1, 2, 3, 4)],
                                  ITEMS_SCHEMA)
    assign = spark.createDataFrame([(10, "control")], "user_id bigint, variant string")
    fct = experiment.fct_experiment_results(assign, orders, items, cfg)
    assert sorted(r.order_id for r in fct.collect()) == [1, 3]


def test_null_user_id_falls_to_treatment(spark):
    users = spark.createDataFrame([(None, TS(2020, 1, 1), "x", 20, "F"), (7, TS(2020, 1, 1), "x", 20, "F")],
                                  "id bigint, created_at timestamp_ntz, country string, age bigint, gender string")
    rows = {r.user_id: (r.variant, r.variant_key)
            for r in staging.stg_experiment_assignments(users).collect()}
    assert rows[None] == ("treatment", None)
    assert rows[7][0] in ("control", "treatment") and rows[7][1] in (0, 1)


def test_assignment_is_stable_under_repartition(spark):
    users = spark.range(0, 5000).select(F.col("id"), F.lit(None).cast("timestamp_ntz").alias("created_at"),
                                        F.lit("x").alias("country"), F.lit(1).cast("bigint").alias("age"),
                                        F.lit("F").alias("gender"))
    a = {r.user_id: r.variant for r in staging.stg_experiment_assignments(users).collect()}
    b = {r.user_id: r.variant for r in staging.stg_experiment_assignments(
        users.repartition(7).orderBy(F.rand(3))).collect()}
    assert a == b
    share = sum(v == "control" for v in a.values()) / len(a)
    assert 0.47 < share < 0.53


def test_relationship_unique_notnull_accepted_failures(spark):
    items = spark.createDataFrame([
        item(1, 1, 10, 100, "Complete", 1.0),
        item(2, 99, 10, 100, "Complete", 1.0),     # unknown order
        item(3, 1, 98, 100, "Complete", 1.0),      # unknown user
        item(4, 1, 10, 97, "Complete", 1.0),       # unknown product
        item(4, 1, 10, 100, "Complete", 1.0),      # duplicate item id
        ("i5", None, 10, 100, "Complete", None, None, None, None, 1.0),  # NULL order id
    ], ITEMS_SCHEMA)
    orders = spark.createDataFrame([order(1, 10, "Complete"), order(2, 10, "Lost")], ORDERS_SCHEMA)
    users = spark.createDataFrame([user(10, "Search")], USERS_SCHEMA)
    prods = spark.createDataFrame([product(100, "A", 1.0)], PRODUCTS_SCHEMA)
    models = {"fct_order_items": items, "dim_orders": marts.dim_orders(orders),
              "dim_users": users, "dim_products": prods}
    checks = [c for c in quality.SHOP_CHECKS if c.model in ("fct_order_items", "dim_orders")]
    got = {(r.test_name, r.model, r.column_name): r.failures
           for r in quality.run_checks(models, checks).collect()}
    assert got[("relationships", "fct_order_items", "order_id")] == 1
    assert got[("relationships", "fct_order_items", "user_id")] == 1
    assert got[("relationships", "fct_order_items", "product_id")] == 1
    assert got[("unique", "fct_order_items", "order_item_id")] == 1
    assert got[("not_null", "fct_order_items", "order_id")] == 1
    assert got[("accepted_values", "dim_orders", "status")] == 1
    assert got[("unique", "dim_orders", "order_id")] == 0


def test_rate_bounds_null_passes(spark):
    cat = spark.createDataFrame([("A", 1.2, 0.1), ("B", -0.1, 0.2), ("C", 0.5, -0.5), ("D", None, None)],
                                "category string, return_rate double, gross_margin_pct double")
    ret = spark.createDataFrame([], "cohort_month date, repeat_purchase_rate double")
    ch = spark.createDataFrame([], "traffic_source string, repeat_purchase_rate double")
    rows = sorted((r.grain, r.value) for r in quality.rate_bounds(cat, ret, ch).collect())
    assert rows == [("A", 1.2), ("B", -0.1)]


def _fct(spark, rows):
    return spark.createDataFrame(rows, "order_id bigint, user_id bigint, variant string, "
                                       "order_value double, is_completed int, is_returned int")


def test_zero_variance_and_missing_variant_give_null(spark):
    fct = _fct(spark, [(1, 1, "control", 10.0, 1, 0), (2, 2, "control", 10.0, 1, 0)])
    m = experiment.variant_moments(fct)
    w = statistics.aov_welch(m).collect()[0]
    z = statistics.conversion_ztest(m).collect()[0]
    assert w.t_stat is None and w.p_value is None and w.df_welch is None
    assert z.z_stat is None and z.p_value is None and z.rate_treatment is None
    fct2 = _fct(spark, [(1, 1, "control", 10.0, 1, 0), (2, 2, "control", 10.0, 1, 0),
                        (3, 3, "treatment", 10.0, 1, 0), (4, 4, "treatment", 10.0, 1, 0)])
    w2 = statistics.aov_welch(experiment.variant_moments(fct2)).collect()[0]
    assert w2.t_stat is None and w2.mean_diff == 0.0


def test_duplicate_order_header_fans_out_fact(spark):
    items = spark.createDataFrame([item(1, 1, 10, 100, "Complete", 1.0)], ITEMS_SCHEMA)
    orders = spark.createDataFrame([order(1, 10, "Complete", n=1), order(1, 10, "Complete", n=2)],
                                   ORDERS_SCHEMA)
    f = marts.fct_order_items(items, orders).collect()
    assert sorted(r.num_of_item for r in f) == [1, 2]


def test_decision_precedence(spark):
    base = dict(n_control=100, n_treatment=100, mean_diff=10.0, relative_lift=0.10, p_value=0.01)
    cases = [
        (dict(base), dict(return_rate_diff=0.05, breached=True), "guardrail_breach"),
        (dict(base, mean_diff=-10.0, relative_lift=-0.1), dict(return_rate_diff=0.0, breached=False), "loss"),
        (dict(base), dict(return_rate_diff=0.0, breached=False), "win"),
        (dict(base, relative_lift=0.01, mean_diff=1.0), dict(return_rate_diff=0.0, breached=False),
         "significant_below_mde"),
        (dict(base, p_value=0.5), dict(return_rate_diff=0.0, breached=False), "inconclusive"),
    ]
    sizing = spark.createDataFrame([(50, 100)], "n_per_variant bigint, n_total bigint")
    for w, g, want in cases:
        wdf = spark.createDataFrame([tuple(w.values())], list(w.keys()))
        gdf = spark.createDataFrame([tuple(g.values())], list(g.keys()))
        d = statistics.experiment_decision(wdf, gdf, sizing).collect()[0]
        assert d.decision == want
        assert d.sample_sufficient and d.captured_orders == 200


@pytest.mark.parametrize("n", [1, 2, 5])
def test_small_groups(spark, n):
    fct = _fct(spark, [(i, i, v, float(i), 1, 0) for i in range(n) for v in ("control", "treatment")])
    s = experiment.variant_summary(fct).collect()
    assert len(s) == 2


def test_unique_on_wide_keys_matches_counter(spark):
    import collections

    rnd = __import__("random").Random(4)
    vals = [f"k{rnd.randint(0, 3000)}|{rnd.randint(0, 9)}" for _ in range(4000)] + ["hot"] * 1500 + [None]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "s string, n bigint")
    want = sorted(k for k, c in collections.Counter(v for v in vals if v is not None).items() if c > 1)
    got = sorted(r.s for r in quality.duplicated_values(df, "s").collect())
    assert got == want
    # fixed-width keys take the direct path
    assert quality.duplicated_values(df, "n").count() == 0


def test_whisker_never_ends_inside_the_box(spark):
    fct = _fct(spark, [(i, i, "control", v, 1, 0) for i, v in enumerate([0.0, 0.0, 0.0, 100.0])])
    r = charts.order_value_boxplot(fct).first()
    assert (r.q1, r.q3, r.whisker_low, r.whisker_high, r.outliers) == (0.0, 25.0, 0.0, 25.0, 1)


def test_decision_and_interval_use_unrounded_statistics(spark):
    """A p-value just below alpha that rounds to it is significant everywhere."""
    n, se = 10 ** 9, (2 * 1e12 / 10 ** 9) ** 0.5
    for t, significant in ((1.959965, True), (1.959963, False)):
        moments = spark.createDataFrame(
            [(n, n, n // 2, n // 2, 0, 0, 1000.0, 1000.0 + t * se, 1e12, 1e12)],
            "n_c long, n_t long, conv_c long, conv_t long, ret_c long, ret_t long, "
            "mean_c double, mean_t double, var_c double, var_t double")
        sizing = spark.createDataFrame([(50, 100)], "n_per_variant bigint, n_total bigint")
        welch = statistics.exact_welch(moments)
        assert statistics.aov_welch(moments).first().p_value == 0.05
        assert statistics.aov_welch(moments).first().significant == significant
        decision = statistics.experiment_decision(
            welch, statistics.exact_guardrail(moments), sizing).first()
        assert decision.p_value == 0.05
        assert decision.decision == ("win" if significant else "inconclusive")
        chart = statistics.interval_chart(moments, statistics.exact_ztest(moments), welch)
        aov = chart.where("metric = 'average_order_value'").collect()
        assert all(r.significant == significant for r in aov)


def test_repeated_orders_fail_the_uniqueness_check(spark, tmp_path):
    import shutil

    from cartwright.plans.models import Models
    for name in ("customer", "nation", "lineitem", "part"):
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", tmp_path)
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    again = orders.orderBy("o_orderkey").limit(100)
    orders.union(again).write.parquet(f"{tmp_path}/orders.parquet")
    models = Models.from_tpch_dir(spark, str(tmp_path))
    assert models.stg_orders.count() == orders.count() + 100
    assert quality.duplicated_values(models.stg_orders, "order_id").count() == 100


def test_unknown_quantile_method_raises():
    from cartwright.operators.quantiles import quantile_columns
    with pytest.raises(ValueError, match="unknown quantile method"):
        quantile_columns("exakt")


def test_window_and_status_filters_reach_the_scan(spark):
    from cartwright.plans.queries import queries
    plan = queries()["baseline_return_rate"](spark, "/root/testdata/sf0.001")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "hashpartitioning" not in text
    fact = queries()["fct_experiment_results"](spark, "/root/testdata/sf0.001")
    text = fact._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in text
