"""Model build (written tables, re-read) and the streaming moments read-out."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from cartwright.operators.experiment import variant_moments
from cartwright.plans.build import TABLES, build_from_tpch
from cartwright.streaming.experiment_monitor import start_monitor
from tests.conftest import SF001


def test_build_writes_tables_and_checks_pass(spark):
    out = build_from_tpch(spark, SF001)
    assert set(out["paths"]) == set(TABLES)
    for name in ("mart_category_performance", "mart_channel_performance", "mart_customer_retention"):
        built = sorted(out["models"][name].collect())
        direct = sorted(E.queries()[name](spark, SF001).collect())
        assert built == direct
    checks = out["checks"].collect()
    assert len(checks) == 53 and all(r.passed for r in checks)


def test_streaming_moments_equal_batch(spark, tmp_path):
    fct = E.queries()["fct_experiment_results"](spark, SF001)
    fact_dir = str(tmp_path / "fact")
    # two arrivals of files
    fct.where(F.col("order_id") % 2 == 0).write.parquet(fact_dir, mode="append")
    fct.where(F.col("order_id") % 2 == 1).write.parquet(fact_dir, mode="append")
    q = start_monitor(spark, fact_dir, "moments_test", checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = spark.table("moments_test").first().asDict()
    want = variant_moments(fct).first().asDict()
    for k, v in want.items():
        if isinstance(v, float):
            assert abs(got[k] - v) <= 1e-9 * max(1.0, abs(v)), k
        else:
            assert got[k] == v, k


def test_shop_schema_tables_on_disk_give_same_results(spark, tmp_path):
    from cartwright.plans.models import ExperimentModels, Models
    from cartwright.sources.tables import TableSource
    from cartwright.sources.shop import from_tables, from_tpch
    src = from_tpch(TableSource(spark, SF001))
    for name in ("users", "orders", "order_items", "products"):
        getattr(src, name).write.parquet(str(tmp_path / name))
    disk = Models(from_tables(TableSource(spark, str(tmp_path))))
    direct = Models(src)
    for name in ("mart_category_performance", "mart_customer_retention", "mart_channel_performance"):
        assert sorted(getattr(disk, name).collect()) == sorted(getattr(direct, name).collect())
    a = ExperimentModels(disk).aov_welch.first()
    b = ExperimentModels(direct).aov_welch.first()
    assert a == b


def test_catalog_tables_by_qualified_name(spark, tmp_path):
    """SC3/SK2: shop tables saved to the catalog and scanned by db.table name."""
    from cartwright.plans.models import Models
    from cartwright.sources.sinks import save_as_table
    from cartwright.sources.tables import TableSource
    from cartwright.sources.shop import from_tables, from_tpch
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shop_test LOCATION '{tmp_path}/wh'")
    src = from_tpch(TableSource(spark, SF001))
    names = {}
    for name in ("users", "orders", "order_items", "products"):
        save_as_table(getattr(src, name), f"shop_test.{name}")
        names[name] = f"shop_test.{name}"
    cat = Models(from_tables(TableSource(spark), names))
    direct = Models(src)
    assert sorted(cat.mart_channel_performance.collect()) == sorted(direct.mart_channel_performance.collect())


def test_dashboard_variant_filter(spark):
    from cartwright.operators.dashboard import dashboard_by_variant, dashboard_cards
    fct = E.queries()["fct_experiment_results"](spark, SF001)
    all_cards = dashboard_cards(fct).first()
    ctl = dashboard_cards(fct, variants=["control"]).first()
    assert ctl.control_orders == all_cards.control_orders and ctl.treatment_orders == 0
    assert ctl.treatment_aov is None
    assert [r.variant for r in dashboard_by_variant(fct, variants=["treatment"]).collect()] == ["treatment"]


def test_command_line_query_and_unknown(spark, capsys):
    from cartwright.__main__ import main
    assert main(["query", "experiment_preview", "--sf-dir", SF001, "--rows", "5"]) == 0
    assert "order_id" in capsys.readouterr().out
    assert main(["query", "no_such_query", "--sf-dir", SF001]) == 2


def test_command_line_on_shop_tables_with_parameters(spark, tmp_path, capsys):
    from cartwright.__main__ import main
    from cartwright.sources.shop import from_tpch
    from cartwright.sources.tables import TableSource
    src = from_tpch(TableSource(spark, SF001))
    for name in ("users", "orders", "order_items", "products"):
        getattr(src, name).write.parquet(f"{tmp_path}/{name}")
    where = ["--tables", str(tmp_path), "--start", "1997-01-01", "--end", "1997-03-31",
             "--alpha", "0.1", "--mde", "0.2"]
    assert main(["query", "variant_balance", *where]) == 0
    assert "control" in capsys.readouterr().out
    assert main(["build", *where]) == 0
    out = capsys.readouterr().out
    path = next(line.split()[1] for line in out.splitlines()
                if line.strip().startswith("fct_experiment_results"))
    days = spark.read.parquet(path).selectExpr("min(order_created_at) a", "max(order_created_at) b")
    first, last = days.first()
    assert str(first) >= "1997-01-01" and str(last) < "1997-04-01"
    assert "assert_rates_within_bounds" in out
