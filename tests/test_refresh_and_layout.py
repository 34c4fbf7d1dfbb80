"""Full refresh behind one switch, and the bucketed layout of the order id."""

import threading

import pytest

from cartwright.plans import build as B
from cartwright.sources.sinks import Runs
from cartwright.sources.shop import from_tpch
from cartwright.sources.tables import TableSource
from tests.conftest import SF001

SHOWN = ("mart_category_performance", "mart_channel_performance")


def sources(spark):
    return from_tpch(TableSource(spark, SF001))


def halved(spark):
    """The same shop with half of its lines, so that a rebuild shows."""
    src = sources(spark)
    src.item_lines = src.item_lines.where("order_id % 2 = 0")
    src.order_items = src.order_items.where("order_id % 2 = 0")
    return src


def totals(runs):
    return tuple(runs.table(n).agg({"*": "count"}).first()[0] for n in SHOWN) + (
        runs.table("fct_order_items").count(),)


def test_readers_see_whole_runs_only(spark, tmp_path):
    runs = Runs(spark, f"file://{tmp_path}/runs", keep=2)
    with pytest.raises(ValueError):
        runs.table("dim_users")
    first = B.build(spark, sources(spark), run_checks=False, runs=runs)
    whole = totals(runs)
    held = runs.table("fct_order_items")  # a reader that opened the first run
    seen, done = [], threading.Event()

    def read():
        while not done.is_set():
            seen.append((runs.current(), totals(runs)))

    reader = threading.Thread(target=read)
    reader.start()
    try:
        second = B.build(spark, halved(spark), run_checks=False, runs=runs)
    finally:
        done.set()
        reader.join(60)
    half = totals(runs)
    assert half[2] < whole[2]
    assert len(seen) > 1 and {s for _, s in seen} <= {whole, half}
    assert all(s == whole for run, s in seen[:1])
    assert runs.current() == second["run_id"] != first["run_id"]
    assert held.count() == whole[2]
    assert spark.table("fct_order_items").count() == half[2]  # the view of this session


def test_old_and_failed_runs_leave_no_folder(spark, tmp_path, monkeypatch):
    runs = Runs(spark, f"file://{tmp_path}/runs", keep=2)
    ids = [B.build(spark, sources(spark), run_checks=False, runs=runs, buckets=2)["run_id"]
           for _ in range(3)]
    assert runs.ids() == ids[1:] and runs.current() == ids[2]
    tables = {t.name for t in spark.catalog.listTables() if t.name.startswith("run_")}
    assert not any(ids[0][:20] in t for t in tables)

    def broken(self):
        raise RuntimeError("a source is gone")
    monkeypatch.setattr(B.Models, "mart_channel_performance", property(broken))
    with pytest.raises(RuntimeError, match="gone"):
        B.build(spark, sources(spark), run_checks=False, runs=runs, buckets=2)
    assert runs.ids() == ids[1:] and runs.current() == ids[2]
    assert not [p for p in (tmp_path / "runs").iterdir() if p.name.startswith("_next")]
    with pytest.raises(ValueError):
        Runs(spark, keep=0)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(order_id")


def test_bucketed_orders_and_lines_join_without_exchange(spark, tmp_path):
    from cartwright.operators.experiment import DEFAULT, fct_experiment_results
    runs = Runs(spark, f"file://{tmp_path}/runs", keep=1)
    out = B.build(spark, sources(spark), run_checks=False, runs=runs, buckets=8)
    stored = {n: spark.table(t) for n, t in out["bucketed"].items()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        def fact(orders, lines):
            return fct_experiment_results(out["models"]["stg_experiment_assignments"], orders,
                                          lines, DEFAULT)
        laid_out = fact(stored["stg_orders"], stored["item_lines"])
        plain = fact(spark.read.parquet(f"{out['root']}/stg_orders"),
                     spark.read.parquet(f"{out['root']}/item_lines"))
        assert exchanges(laid_out) == 0 < exchanges(plain)
        assert sorted(laid_out.collect()) == sorted(plain.collect()) == sorted(
            out["models"]["fct_experiment_results"].collect())
        baskets = stored["item_lines"].groupBy("order_id").count()
        assert exchanges(baskets) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", before)
