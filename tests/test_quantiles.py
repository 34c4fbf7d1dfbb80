"""Distributed exact quantiles vs numpy on skewed, tied and tiny groups."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from cartwright.operators.quantiles import approx_quantiles, exact_quantiles

PROBS = [0.0, 0.25, 0.5, 0.75, 1.0]


def _check(spark, groups: dict, **how):
    rows = [(g, float(v)) for g, vals in groups.items() for v in vals]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r for r in exact_quantiles(df, ["g"], "x", PROBS, **how).collect()}
    assert set(got) == {g for g, v in groups.items() if len(v)}
    for g, vals in groups.items():
        want = np.quantile(np.array(vals, dtype=float), PROBS)  # linear, as pandas/numpy
        have = [getattr(got[g], f"q{int(p * 100):02d}") for p in PROBS]
        assert have == pytest.approx(list(want), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("how", [{}, {"bins": 4, "passes": 1}, {"bins": 8, "passes": 3}])
def test_hot_value_third_of_rows(spark, how):
    rng = np.random.default_rng(1)
    a = list(rng.normal(100, 30, 3000).round(2)) + [42.0] * 1500   # one value holds a third
    b = list(rng.exponential(50, 2000).round(2))
    _check(spark, {"control": a, "treatment": b}, **how)


def test_single_values_and_pairs(spark):
    _check(spark, {"a": [5.0], "b": [1.0, 2.0], "c": [3.0, 3.0, 3.0]})


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.sampled_from(["u", "v", "w"]),
                       st.lists(st.integers(-50, 50), min_size=1, max_size=40), min_size=1))
def test_property_matches_numpy(spark, groups):
    _check(spark, {k: [float(x) for x in v] for k, v in groups.items()}, bins=4)


def test_outliers_infinities_and_nulls(spark):
    rng = np.random.default_rng(4)
    near = list(rng.normal(0, 1, 500))
    _check(spark, {"a": near + [1e300, -1e300], "b": [1e308, -1e308, 0.0, 1.0], "c": near + [1e12]})
    rows = [("a", 1.0), ("a", None), ("a", float("nan")), ("b", None), (None, 5.0),
            ("c", float("inf")), ("c", 2.0), ("c", 3.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.q50 for r in exact_quantiles(df, ["g"], "x", [0.5]).collect()}
    assert got == {"a": 1.0, "c": 3.0}


def test_groups_of_several_columns(spark):
    rows = [(i % 3, "x" if i % 2 else "y", float(i * i % 101)) for i in range(600)]
    df = spark.createDataFrame(rows, "a int, b string, x double")
    got = {(r.a, r.b): r.m for r in exact_quantiles(df, ["a", "b"], "x", [0.5], ["m"]).collect()}
    want = {(a, b): float(np.quantile([x for c, d, x in rows if (c, d) == (a, b)], 0.5))
            for a, b, _ in rows}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("name", ["variant_summary", "order_value_boxplot",
                                  "order_value_outliers"])
def test_quantile_queries_start_no_job_and_write_no_file(spark, name, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    import __spark_entry__ as E
    from tests.conftest import SF001

    def refuse(*_, **__):
        raise AssertionError("a file is written")
    for how in ("parquet", "save", "saveAsTable", "orc"):
        monkeypatch.setattr(DataFrameWriter, how, refuse)
    query = E.queries()[name]
    query(spark, SF001)  # the readers' own schema jobs come first
    sc = spark.sparkContext
    sc.setJobGroup(f"build-{name}", name)
    try:
        df = query(spark, SF001)
        jobs = sc.statusTracker().getJobIdsForGroup(f"build-{name}")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs
    assert df.count() > 0


def test_narrowing_reads_the_values_once(spark):
    """All passes read one exchange of the collapsed values."""
    df = spark.range(20000).selectExpr("CAST(id % 2 AS STRING) AS g", "CAST(id % 5000 AS DOUBLE) AS x")
    q = exact_quantiles(df, ["g"], "x", [0.25, 0.5])
    q.collect()
    # scans of the range that were executed: the other passes reuse its shuffle
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "SortMergeJoin" not in plan


def test_approx_is_close(spark):
    rng = np.random.default_rng(3)
    vals = rng.normal(0, 1, 5000)
    df = spark.createDataFrame([("g", float(v)) for v in vals], "g string, x double")
    r = approx_quantiles(df, ["g"], "x", [0.5], names=["m"]).collect()[0]
    assert abs(r.m - np.median(vals)) < 0.01


def test_config_switches_summary_to_sketch(spark):
    import __spark_entry__ as E
    from cartwright.operators.experiment import ExperimentConfig, variant_summary
    from tests.conftest import SF01
    fct = E.queries()["fct_experiment_results"](spark, SF01)
    exact = {r.variant: r.median_order_value for r in variant_summary(fct).collect()}
    approx = {r.variant: r.median_order_value
              for r in variant_summary(fct, ExperimentConfig(quantiles="approx")).collect()}
    assert set(exact) == set(approx)
    for v in exact:   # the sketch returns a data value within its rank error
        assert abs(approx[v] - exact[v]) / exact[v] < 0.05
