"""Every registered query against its DuckDB oracle (driver's correctness gate)."""

import pytest

import __spark_entry__ as E
from cartwright.plans.check import duckdb_connection, run_pair
from cartwright.plans.oracle import oracle_sql
from cartwright.plans.queries import queries
from tests.conftest import SF001, SF01

# the analytics queries; the training-data operators have their own tests
QUERIES = queries()
ORACLE = oracle_sql()

# the few queries also checked at sf0.01, where FIXTURES.md has values
SF01_KEYS = ["mart_category_performance", "mart_customer_retention", "mart_channel_performance",
             "conversion_ztest", "aov_welch", "dq_results"]


@pytest.fixture(scope="module")
def con001():
    return duckdb_connection(SF001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle_sf0001(spark, con001, name):
    r = run_pair(spark, name, SF001, QUERIES[name], ORACLE[name], con001)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    # doubles summed in a different order can differ in the last bit, which
    # flips a rounded value only on an exact decimal tie: compare to 1e-9
    assert r["ok"], r


@pytest.mark.parametrize("name", SF01_KEYS)
def test_matches_oracle_sf001(spark, name):
    r = run_pair(spark, name, SF01, QUERIES[name], ORACLE[name])
    assert r["exact"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["category", "department", "items_ordered", "items_sold", "items_returned",
                          "gross_revenue", "cost_of_goods", "gross_margin", "gross_margin_pct",
                          "return_rate"]


def test_display_query_rows(spark):
    rows = QUERIES["variant_summary_display"](spark, SF001).collect()
    assert {r.variant for r in rows} <= {"control", "treatment"}
    assert all(r.avg_order_value.startswith("£") and r.conversion_rate.endswith("%") for r in rows)


SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                   "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def test_column_types_match_oracle(spark, con001):
    """Column types agree exactly (e.g. counts are BIGINT on both sides, never HUGEINT)."""
    bad = []
    for name, sql in ORACLE.items():
        spark_types = dict(QUERIES[name](spark, SF001).dtypes)
        duck_types = {r[0]: r[1] for r in con001.execute("DESCRIBE " + sql).fetchall()}
        bad += [(name, c, t, duck_types.get(c)) for c, t in spark_types.items()
                if SPARK_TO_DUCKDB.get(t, t) != duck_types.get(c)]
    assert not bad, bad
