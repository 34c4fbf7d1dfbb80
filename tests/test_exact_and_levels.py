"""Exact sums, fused checks, composite keys, orphans, bounds, cube, levels, full names."""

import collections
import datetime as dt
import random
import statistics as st
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cartwright.functions import moments as M
from cartwright.operators import calendar, dashboard, experiment, quality
from cartwright.operators.quality import Bound, Check
from tests.conftest import SF001

Q = E.queries()


# --- exact sums ----------------------------------------------------------------------

def test_sums_do_not_depend_on_the_order_of_rows(spark):
    rnd = random.Random(1)
    prices = [round(rnd.lognormvariate(4, 3), 2) for _ in range(5000)] + [0.1, 0.2, -0.3, None]
    exact = sum(Decimal(str(p)) for p in prices if p is not None)
    found = set()
    for seed in range(4):
        random.Random(seed).shuffle(prices)
        df = spark.createDataFrame([(p,) for p in prices], "x double").repartition(3 + seed)
        r = df.agg(M.exact_sum(F.col("x")).alias("s"), *M.sums(F.col("x"), "v")).select(
            "s", M.mean("v").alias("mean"), M.variance("v").alias("var")).first()
        found.add(tuple(r))
    (s, mean, var), = found
    known = [p for p in prices if p is not None]
    assert s == float(exact)
    assert mean == pytest.approx(st.mean(known), rel=1e-14)
    assert var == pytest.approx(st.variance([Decimal(str(p)) for p in known]).__float__(), rel=1e-13)


def test_variance_does_not_cancel(spark):
    # a spread of cents on amounts of ten million
    known = [10_000_000.00, 10_000_000.01, 10_000_000.02]
    df = spark.createDataFrame([(x,) for x in known], "x double")
    r = df.agg(*M.sums(F.col("x"), "v")).select(M.mean("v"), M.variance("v")).first()
    assert r[0] == 10_000_000.01 and r[1] == pytest.approx(0.0001, rel=1e-12)
    for rows, want in (([], (None, None)), ([(5.0,)], (5.0, None)), ([(5.0,), (5.0,)], (5.0, 0.0)),
                       ([(float("nan"),), (None,)], (None, None))):
        df = spark.createDataFrame(rows, "x double")
        assert tuple(df.agg(*M.sums(F.col("x"), "v")).select(
            M.mean("v"), M.variance("v")).first()) == want


def test_states_merge_to_the_same_moments(spark):
    rnd = random.Random(2)
    df = spark.createDataFrame([(i % 17, round(rnd.uniform(0, 900), 2)) for i in range(2000)],
                               "g int, x double")
    whole = df.agg(*M.sums(F.col("x"), "v")).select(M.mean("v"), M.variance("v")).first()
    parts = df.groupBy("g").agg(*M.sums(F.col("x"), "v")).agg(*M.merged("v"))
    assert parts.select(M.mean("v"), M.variance("v")).first() == whole


# --- the suite -------------------------------------------------------------------------

def test_composite_key_is_red_on_a_planted_pair(spark):
    cat = spark.createDataFrame(
        [("A", "Men", 1.0, 1.0), ("A", "Women", 1.0, 1.0), ("B", "Men", 1.0, 1.0),
         ("B", None, 1.0, 1.0), ("B", None, 1.0, 1.0)],
        "category string, department string, gross_revenue double, gross_margin double")
    checks = [c for c in quality.SHOP_CHECKS if c.model == "mart_category_performance"]

    def failures(df):
        return {(r.test_name, r.column_name): r.failures
                for r in quality.run_checks({"mart_category_performance": df}, checks).collect()}
    key = ("unique", "category, department")
    assert failures(cat)[key] == 0
    assert failures(cat.union(cat.where("department = 'Men'")))[key] == 2
    # no value can stand in for another column's
    tricky = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("a,b", "c"), ("a", "b,c")],
                                   "x string, y string")
    assert quality.run_checks({"t": tricky}, [Check("unique", "t", "x, y")]).first().failures == 0


def plain_failures(rows, test, column=0, values=(), parents=()):
    known = [r for r in rows if r is not None]
    if test == "not_null":
        return len(rows) - len(known)
    if test == "unique":
        return sum(n > 1 for n in collections.Counter(known).values())
    if test == "accepted_values":
        return len(set(known) - set(values))
    return sum(r not in parents for r in known)


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_all_checks_of_a_model_in_one_pass_equal_plain_counts(spark, kind):
    rnd = random.Random(3)
    keys = [rnd.choice([None, 7, 7, rnd.randint(-300, 300), rnd.randint(-2**31, 2**31 - 1)])
            for _ in range(1500)]
    parents = [k for k in {k for k in keys if k is not None} if rnd.random() < 0.7] + [7, 10**6]
    cast = (lambda x: None if x is None else str(x)) if kind == "string" else (lambda x: x)
    keys, parents = [*map(cast, keys)], [*map(cast, parents)]
    child = spark.createDataFrame([(k, i % 3) for i, k in enumerate(keys)], f"k {kind}, v int")
    parent = spark.createDataFrame([(k,) for k in parents + [None]], f"id {kind}")
    checks = [Check("not_null", "c", "k"), Check("unique", "c", "k"),
              Check("accepted_values", "c", "v", (0, 1)),
              Check("relationships", "c", "k", parent="p", parent_column="id"),
              Check("accepted_values", "c", "k", tuple(parents[:5]))]
    got = [r.failures for r in quality.run_checks({"c": child, "p": parent}, checks).collect()]
    assert got == [plain_failures(keys, "not_null"), plain_failures(keys, "unique"), 1,
                   plain_failures(keys, "relationships", parents=set(parents)),
                   plain_failures(keys, "accepted_values", values=parents[:5])]


def test_orphans_beyond_the_list_are_counted_all_the_same(spark, monkeypatch):
    monkeypatch.setattr(quality, "MOST_WORDS", 3)
    child = spark.range(0, 20000).selectExpr("id * 7 AS k").union(spark.range(100).selectExpr("id AS k"))
    parent = spark.range(0, 20000).selectExpr("id * 14 AS id")
    check = [Check("relationships", "c", "k", parent="p", parent_column="id")]
    got = quality.run_checks({"c": child, "p": parent}, check).first().failures
    want = child.join(parent, child.k == parent.id, "left_anti").count()
    assert got == want > 0


def test_a_clean_child_moves_words_instead_of_keys(spark):
    parent = spark.range(0, 64_000)
    child = spark.range(0, 640_000).selectExpr("id % 64000 AS k")
    words = quality.orphan_words([(0, child, "k", parent, "id")])
    assert words.count() == 0
    plan = words._jdf.queryExecution().executedPlan()
    # rows that the exchange of the words wrote: at most one a word, side and task
    text = plan.toString()
    assert "bit_or" in text and "SortMergeJoin" not in text
    stage = [n for n in _nodes(plan) if n.nodeName() == "Exchange"][0]
    assert stage.metrics().apply("shuffleRecordsWritten").value() <= 1000 * 2 * 16


def _nodes(plan):
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        out.append(node)
        for inner in ("executedPlan", "plan"):
            if node.getClass().getSimpleName() in ("AdaptiveSparkPlanExec", "ShuffleQueryStageExec") \
                    and hasattr(node, inner):
                try:
                    todo.append(getattr(node, inner)())
                except Exception:  # the node has no such member
                    pass
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def test_each_model_is_read_at_most_twice(spark):
    df = spark.range(1000).selectExpr("id AS a", "CAST(id AS STRING) AS b", "id % 2 AS c")
    df.write.mode("overwrite").parquet("/tmp/cartwright-test-suite-read")
    model = spark.read.parquet("/tmp/cartwright-test-suite-read")
    checks = [Check("not_null", "m", x) for x in "abc"] + [Check("unique", "m", x) for x in "ab"] + [
        Check("accepted_values", "m", "c", (0, 1)), Check("unique", "m", "a, b")]
    out = quality.run_checks({"m": model}, checks)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert [r.failures for r in out.collect()] == [0] * len(checks)


def test_bounds_are_a_table_of_rules(spark):
    rates = spark.createDataFrame([("a", 0.1, 2.0), ("b", 0.9, -2.0), ("c", None, 0.0), ("d", 0.5, 1.0)],
                                  "name string, r double, s double")
    rules = (Bound("low", "m", "r", 0.2, 1.0), Bound("high", "m", "r", 0.0, 0.8),
             Bound("both", "m", "s", -1, 1))
    got = sorted(map(tuple, quality.bounds({"m": rates}, rules, {"m": "name"}).collect()))
    assert got == [("both", "a", 2.0), ("both", "b", -2.0), ("high", "b", 0.9), ("low", "a", 0.1)]
    plan = quality.bounds({"m": rates}, rules, {"m": "name"})._jdf.queryExecution().toString()
    assert "Union" not in plan


# --- levels and cells --------------------------------------------------------------------

DAY = dt.datetime


def fact(spark, rows):
    return spark.createDataFrame(
        [(i, i, v, s, t, x, 1, int(s == "Complete"), int(s == "Returned"))
         for i, (v, s, t, x) in enumerate(rows)],
        "order_id bigint, user_id bigint, variant string, order_status string, "
        "order_created_at timestamp_ntz, order_value double, item_count bigint, "
        "is_completed int, is_returned int")


ROWS = [("control", "Complete", DAY(2023, 12, 31, 23), 10.0), ("control", "Returned", DAY(2024, 2, 1), 20.0),
        ("treatment", "Complete", DAY(2024, 10, 1), 30.01), ("treatment", "Complete", DAY(2024, 2, 1), None),
        (None, "Complete", DAY(2024, 9, 9), 5.0), ("control", None, DAY(2024, 9, 9), 7.5)]


def test_drilldown_levels_come_in_the_order_of_numbers(spark):
    rows = calendar.calendar_drilldown(fact(spark, ROWS)).collect()
    assert [r.level for r in rows].count(0) == 1 and rows[0].orders == 6
    for level, n in ((1, 2), (2, 4), (3, 4), (4, 4)):
        own = [r for r in rows if r.level == level]
        assert len(own) == n and sum(r.orders for r in own) == 6
    months = [r.month for r in rows if r.level == 3]
    assert months == ["December", "February", "September", "October"]
    assert [(r.year, r.quarter_no, r.month_no, r.day) for r in rows] == sorted(
        (r.year, r.quarter_no, r.month_no, r.day) for r in rows)
    feb = next(r for r in rows if r.level == 3 and r.month == "February")
    assert (feb.orders, feb.aov, feb.conversion_rate) == (2, 20.0, 0.5)


def test_drilldown_and_balance_read_the_fact_once(spark, tmp_path):
    fact(spark, ROWS).write.parquet(f"{tmp_path}/f")
    f = spark.read.parquet(f"{tmp_path}/f")
    for df in (calendar.calendar_drilldown(f), experiment.variant_balance(f), dashboard.measure_cube(f)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert {(r.variant, r.orders, r.users) for r in experiment.variant_balance(f).collect()} == {
        ("control", 3, 3), ("treatment", 2, 2)}
    assert experiment.variant_balance(f.where("false")).count() == 0


def test_every_cell_of_the_cube_equals_its_filter(spark):
    f = fact(spark, ROWS)
    cube = dashboard.measure_cube(f)
    cells = cube.collect()
    for r in cells:
        own = [x for x in ROWS if x[0] is not None
               and r.variant in ("all", x[0]) and r.order_status in ("all", x[1] or "unknown")
               and r.order_month in ("all", x[2].strftime("%Y-%m"))]
        known = [x[3] for x in own if x[3] is not None]
        assert r.orders == len(own) > 0
        assert r.aov == (round(sum(known) / len(known), 4) if known else None)
        assert r.conversion_rate == round(sum(x[1] == "Complete" for x in own) / len(own), 6)
    assert len({(r.variant, r.order_status, r.order_month) for r in cells}) == len(cells)
    one = dashboard.cell(cube, variant="control", month="2024-02").collect()
    assert [(r.orders, r.return_rate) for r in one] == [(1, 1.0)]
    assert dashboard.cell(cube, variant="nobody").count() == 0


def test_filtered_cards_equal_the_filtered_fact(spark):
    f = fact(spark, ROWS)
    cards = {r.variant_filter: r for r in dashboard.filtered_cards(f).collect()}
    for name, chosen in (("all", None), ("control", ["control"]), ("treatment", ["treatment"])):
        want = dashboard.dashboard_cards(f, chosen).first().asDict()
        assert {k: cards[name][k] for k in want} == want


def test_full_names_resolve_through_the_catalog(spark):
    got = Q["baseline_metrics"](spark, SF001).first()
    names = [t.name for t in spark.catalog.listTables("global_temp") if t.name.startswith("shop_")]
    assert {n.rsplit("_", 1)[1] for n in names} >= {"users", "orders", "products"}
    assert got.order_count == Q["baseline_order_value"](spark, SF001).first().order_count
    from cartwright.sources.tables import TableSource
    full = next(n for n in names if n.endswith("_orders"))
    assert TableSource(spark).table(f"global_temp.{full}").count() > 0


def test_all_tests_are_one_projection_over_one_aggregate(spark):
    from cartwright.plans.models import ExperimentModels, Models
    e = ExperimentModels(Models.from_tpch_dir(spark, SF001))
    both = e.tests.select("w.p_value", "z.p_value", "g.breached").first()
    assert both[2] == e.return_guardrail.first().breached
    for df in (e.tests, e.interval_chart):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Subquery" not in plan and plan.count("l_extendedprice#") and plan.count("Relation [l_orderkey") == 1
