"""Distribution functions and tests against the JVM's commons-math3 (tests only)."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cartwright.functions.distributions import (
    normal_two_sided_p, t_quantile_two_sided, t_two_sided_p)
from cartwright.operators import experiment, statistics


def _math3(spark):
    return spark._jvm.org.apache.commons.math3.distribution


@pytest.mark.parametrize("nu", [1.0, 1.2, 1.5, 1.9, 2.0, 2.5, 3.0, 7.3, 30.0, 673.42017, 5000.0, 100000.0])
def test_t_tail_and_quantile(spark, nu):
    ts = [0.0, 0.3963184, 1.0, 2.5, 6.0]
    df = spark.createDataFrame([(t, nu) for t in ts], "t double, nu double")
    rows = df.select("t", t_two_sided_p(F.col("t"), F.col("nu")).alias("p"),
                     t_quantile_two_sided(0.05, F.col("nu")).alias("q"),
                     t_quantile_two_sided(0.01, F.col("nu")).alias("q99")).collect()
    T = _math3(spark).TDistribution(nu)
    rel = 1e-8
    for r in rows:
        assert r.p == pytest.approx(2 * (1 - T.cumulativeProbability(r.t)), abs=1e-9)
        assert r.q == pytest.approx(T.inverseCumulativeProbability(0.975), rel=rel)
        assert r.q99 == pytest.approx(T.inverseCumulativeProbability(0.995), rel=rel)


def test_normal_tail(spark):
    zs = [0.0, 0.5, 1.7295151, 1.96, 3.3, -2.2, 8.0]
    rows = spark.createDataFrame([(z,) for z in zs], "z double").select(
        "z", normal_two_sided_p(F.col("z")).alias("p")).collect()
    N = _math3(spark).NormalDistribution()
    for r in rows:
        assert r.p == pytest.approx(2 * (1 - N.cumulativeProbability(abs(r.z))), abs=1e-10)


def _random_fct(spark, seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = "control" if rnd.random() < 0.5 else "treatment"
        val = rnd.lognormvariate(4.4 if v == "control" else 4.45, 0.8)
        comp = 1 if rnd.random() < 0.74 else 0
        rows.append((i, i % 97, v, round(val, 2), comp, 1 - comp))
    return spark.createDataFrame(rows, "order_id bigint, user_id bigint, variant string, "
                                       "order_value double, is_completed int, is_returned int"), rows


def test_welch_and_z_against_direct_formulas(spark):
    fct, rows = _random_fct(spark, 7)
    m = experiment.variant_moments(fct)
    w = statistics.aov_welch(m).collect()[0]
    z = statistics.conversion_ztest(m).collect()[0]
    c = [r[3] for r in rows if r[2] == "control"]
    t = [r[3] for r in rows if r[2] == "treatment"]

    def mv(x):
        mu = sum(x) / len(x)
        return mu, sum((a - mu) ** 2 for a in x) / (len(x) - 1)
    (mc, vc), (mt, vt) = mv(c), mv(t)
    se = math.sqrt(vc / len(c) + vt / len(t))
    tstat = (mc - mt) / se
    dfw = (vc / len(c) + vt / len(t)) ** 2 / ((vc / len(c)) ** 2 / (len(c) - 1) + (vt / len(t)) ** 2 / (len(t) - 1))
    T = _math3(spark).TDistribution(dfw)
    assert w.t_stat == pytest.approx(round(tstat, 6), abs=2e-6)
    assert w.df_welch == pytest.approx(dfw, abs=1e-4)
    assert w.p_value == pytest.approx(2 * (1 - T.cumulativeProbability(abs(tstat))), abs=2e-6)
    tc = T.inverseCumulativeProbability(0.975)
    assert w.ci_low == pytest.approx((mt - mc) - tc * se, abs=1e-3)
    # z-test: chi-square on the 2x2 table gives z^2 (same p-value)
    cc = sum(r[4] for r in rows if r[2] == "control")
    ct = sum(r[4] for r in rows if r[2] == "treatment")
    p = (cc + ct) / (len(c) + len(t))
    zz = (cc / len(c) - ct / len(t)) / math.sqrt(p * (1 - p) * (1 / len(c) + 1 / len(t)))
    assert z.z_stat == pytest.approx(zz, abs=2e-6)
    N = _math3(spark).NormalDistribution()
    assert z.p_value == pytest.approx(2 * (1 - N.cumulativeProbability(abs(zz))), abs=2e-6)


def test_wilson_interval_reference_values(spark):
    # FIXTURES.md: 271 of 335 and 264 of 350
    m = spark.createDataFrame([(335, 271, 0, 1.0, 1.0, 350, 264, 0, 1.0, 1.0)],
                              "n_c bigint, conv_c bigint, ret_c bigint, mean_c double, var_c double, "
                              "n_t bigint, conv_t bigint, ret_t bigint, mean_t double, var_t double")
    z = statistics.conversion_ztest(m).collect()[0]
    assert (z.ci_low_control, z.ci_high_control) == pytest.approx((0.7634482, 0.8474570), abs=1e-6)
    assert (z.ci_low_treatment, z.ci_high_treatment) == pytest.approx((0.7065836, 0.7964666), abs=1e-6)
    assert z.z_stat == pytest.approx(1.7295151, abs=1e-6)
    assert z.p_value == pytest.approx(0.0837169, abs=1e-6)


def test_sample_size_matches_design_figures(spark):
    b = spark.createDataFrame([(86.03, 93.98, 31144)], "baseline_aov double, aov_stddev double, order_count bigint")
    d = spark.createDataFrame([(12.39,)], "avg_daily_orders double")
    r = experiment.sample_size_and_duration(b, d).collect()[0]
    assert r.n_per_variant == 7494 and r.n_total == 14988
    assert r.duration_days_ceil == 1210
    assert r.mde_absolute == pytest.approx(4.3015, abs=1e-6)


def test_ztest_equals_ml_chisquare_on_driver_data(spark):
    """pyspark.ml ChiSquareTest on variant x completed: chi2 = z^2, same p-value."""
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    import __spark_entry__ as E
    from tests.conftest import SF01
    fct = E.queries()["fct_experiment_results"](spark, SF01)
    z = E.queries()["conversion_ztest"](spark, SF01).first()
    idx = StringIndexer(inputCol="variant", outputCol="v_idx").fit(fct).transform(fct)
    vec = VectorAssembler(inputCols=["v_idx"], outputCol="features").transform(
        idx.withColumn("label", F.col("is_completed").cast("double")))
    r = ChiSquareTest.test(vec, "features", "label").first()
    assert r.statistics[0] == pytest.approx(z.z_stat ** 2, rel=1e-5)
    assert r.pValues[0] == pytest.approx(z.p_value, abs=2e-6)


def test_distribution_sql_matches_spark_both_regimes(spark):
    """The oracle's SQL integrals equal the Spark column expressions (low and high df)."""
    import duckdb

    from cartwright.plans.oracle import normal_p_sql, t_p_sql, t_quantile_sql
    grid = [(t, nu) for nu in (1.0, 1.3, 1.7, 2.0, 4.5, 60.0, 673.42017) for t in (0.0, 0.7, 2.2, 9.0)]
    sdf = spark.createDataFrame(grid, "t double, nu double")
    got = sdf.select("t", "nu", t_two_sided_p(F.col("t"), F.col("nu")).alias("p"),
                     t_quantile_two_sided(0.05, F.col("nu")).alias("q"),
                     normal_two_sided_p(F.col("t")).alias("pz")).collect()
    values = ", ".join(f"({t!r}::DOUBLE, {nu!r}::DOUBLE)" for t, nu in grid)
    sql = (f"SELECT t, nu, {t_p_sql('t', 'nu')} AS p, {t_quantile_sql(0.05, 'nu')} AS q, "
           f"{normal_p_sql('t')} AS pz FROM (VALUES {values}) v(t, nu)")
    want = {(r[0], r[1]): r for r in duckdb.connect().execute(sql).fetchall()}
    for r in got:
        w = want[(r.t, r.nu)]
        assert r.p == pytest.approx(w[2], abs=1e-12)
        assert r.q == pytest.approx(w[3], rel=1e-12)
        assert r.pz == pytest.approx(w[4], abs=1e-13)
