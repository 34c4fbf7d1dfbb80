"""Experiment path on random dirty data vs the oracle SQL on the same rows."""

import datetime as dt
import random

import duckdb
import pandas as pd
import pytest

from cartwright.operators import experiment, staging, statistics
from cartwright.operators.experiment import ExperimentConfig
from cartwright.plans import oracle
from cartwright.plans.check import compare

import shop_sql

CFG = ExperimentConfig(start=dt.date(2020, 3, 1), end=dt.date(2020, 12, 31))
STATUSES = ["Complete", "Returned", "Cancelled", "Shipped", "Processing", None]

USERS = "id bigint, created_at timestamp_ntz, country string, age bigint, gender string"
ORDERS = "order_id bigint, user_id bigint, status string, created_at timestamp_ntz"
ITEMS = "order_id bigint, status string, sale_price double"


def make(seed):
    rnd = random.Random(seed)
    base = dt.datetime(2020, 1, 1)
    users = [(u, base, "x", 30, "F") for u in range(1, 80)] + [(None, base, "x", 30, "F")]
    orders, items = [], []
    for oid in range(1, 400):
        uid = 3 if rnd.random() < 0.3 else rnd.choice([rnd.randint(1, 90), None])   # hot user, orphans
        orders.append((oid, uid, rnd.choice(STATUSES),
                       base + dt.timedelta(days=rnd.randint(0, 420), seconds=rnd.randint(0, 86399))))
        for _ in range(rnd.randint(0, 4)):
            price = None if rnd.random() < 0.05 else round(rnd.lognormvariate(4, 1), 2)
            items.append((oid, rnd.choice(STATUSES), price))
    return users, orders, items


def cols(schema):
    return [c.strip().split(" ")[0] for c in schema.split(",")]


def frame(rows, schema):
    """pandas frame with nullable integers (a NULL id must not turn ids into floats)."""
    df = pd.DataFrame(rows, columns=cols(schema))
    for c, t in (f.strip().split(" ") for f in schema.split(",")):
        if t == "bigint":
            df[c] = df[c].astype("Int64")
    return df


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_experiment_path_matches_sql(spark, seed):
    users, orders, items = make(seed)
    s_users = spark.createDataFrame(users, USERS)
    s_orders = spark.createDataFrame(orders, ORDERS)
    s_items = spark.createDataFrame(items, ITEMS)
    assign = staging.stg_experiment_assignments(s_users)
    fct = experiment.fct_experiment_results(assign, s_orders, s_items, CFG)
    m = experiment.variant_moments(fct, CFG)
    got = {
        "fct_experiment_results": fct,
        "ztest": statistics.conversion_ztest(m, CFG),
        "welch": statistics.aov_welch(m, CFG),
        "guardrail": statistics.return_guardrail(m, CFG),
        "balance": experiment.variant_balance(fct),
        "summary": experiment.variant_summary(fct, CFG),
    }
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.register("src_users", frame(users, USERS))
    con.register("stg_orders", frame(orders, ORDERS))
    con.register("stg_order_items", frame(items, ITEMS))
    con.execute(f"""CREATE VIEW stg_experiment_assignments AS
        SELECT id AS user_id, CASE WHEN {oracle.VARIANT_KEY_SQL} = 0 THEN 'control' ELSE 'treatment' END AS variant
        FROM src_users""")
    stats = oracle._experiment_ctes(CFG)
    moments = stats[stats.index("moments AS ("):stats.index("baseline_order_value AS (")]
    ctes = ",\n".join(b.strip().rstrip(",") for b in [
        shop_sql.experiment_fact(CFG), moments, oracle._ztest_body(CFG), oracle._welch_body(CFG),
        oracle._guardrail_body(CFG)])
    bodies = {
        "fct_experiment_results": "SELECT * FROM fct_experiment_results",
        "ztest": "SELECT * EXCLUDE (exact_p, p_c, p_t, lo_c, hi_c, lo_t, hi_t) FROM ztest",
        "welch": "SELECT * EXCLUDE (exact_p, exact_diff, exact_lift) FROM welch",
        "guardrail": "SELECT * FROM guardrail",
        "balance": """SELECT variant, orders, users, round_even(orders / total * 100, 1) AS pct_orders,
                             orders / total AS share_orders
                      FROM (SELECT variant, count(order_id) AS orders, count(DISTINCT user_id) AS users,
                                   sum(count(order_id)) OVER () AS total
                            FROM fct_experiment_results WHERE variant IS NOT NULL GROUP BY variant)""",
        "summary": """SELECT variant, count(order_id) AS orders, round(avg(order_value), 4) AS avg_order_value,
                             round(median(order_value), 4) AS median_order_value,
                             round(stddev_samp(order_value), 4) AS std_order_value,
                             round(avg(is_completed), 6) AS conversion_rate,
                             round(avg(is_returned), 6) AS return_rate
                      FROM fct_experiment_results WHERE variant IS NOT NULL GROUP BY variant""",
    }
    for name, df in got.items():
        want = con.execute("WITH " + ctes + "\n" + bodies[name]).fetchdf()
        r = compare(df.toPandas(), want)
        assert r["ok"], (seed, name, r.get("first_diff"), r)
