"""Build the models in dependency order, then run the checks (SK1, SK2, DQ6).

The order is a plain list: staging (views) -> star schema and experiment
fact (tables) -> analytics marts (tables). Each table model is written as
Parquet to the folder of this run and read back, so downstream models start
from the written table (lineage cut, lost executors cost a re-read) and no run
overwrites a table another model is reading.

Orders and item lines are stored once in the layout of the order id (bucketed
and sorted), so the fact, the baskets and the experiment join and group them
without an exchange.

When everything is written, readers are switched to the run and old runs go
(``sources.sinks.Runs``). A run that fails leaves no folder, and readers stay
with the run before. The result is a dict of the (re-read) model DataFrames plus
the check results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwright.operators import quality
from cartwright.operators.experiment import ExperimentConfig
from cartwright.plans.models import ExperimentModels, Models
from cartwright.sources.sinks import Runs, as_view, write_bucketed, write_table
from cartwright.sources.tables import TableSource
from cartwright.sources.shop import RetailSources, from_tables, from_tpch

VIEWS = ["stg_users", "stg_orders", "stg_order_items", "stg_products",
         "stg_experiment_assignments"]
TABLES = ["dim_users", "dim_orders", "dim_products", "fct_order_items",
          "fct_experiment_results",
          "mart_category_performance", "mart_customer_retention", "mart_channel_performance"]
#: models that are stored in the layout of a key, for the joins on it
BUCKETED = {"stg_orders": "order_id", "item_lines": "order_id"}
# optional Parquet partition columns per table model (none by default)
PARTITION_BY: dict[str, list[str]] = {}


class _Materialized:
    """``keep`` hook: table models are written and re-read, views registered."""

    def __init__(self, spark: SparkSession, run_root: str, run_id: str, buckets: int):
        self.spark = spark
        self.root = run_root
        self.prefix = _prefix(run_id)
        self.buckets = buckets
        self.paths: dict[str, str] = {}

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        if name in TABLES:
            self.paths[name] = path
            return write_table(df, path, PARTITION_BY.get(name))
        if name in BUCKETED and self.buckets:
            df = write_bucketed(df, path, f"{self.prefix}_{name}", BUCKETED[name], self.buckets)
        if name in VIEWS:
            return as_view(df, name)
        return df



def _prefix(run_id: str) -> str:
    return "run_" + "".join(c if c.isalnum() else "_" for c in run_id)


def _forget(spark: SparkSession, run_id: str) -> None:
    """Take the bucketed tables of a run out of the catalog."""
    for name in BUCKETED:
        spark.sql(f"DROP TABLE IF EXISTS {_prefix(run_id)}_{name}")


def build(spark: SparkSession, sources: RetailSources, run_id: str | None = None,
          run_checks: bool = True, cfg: ExperimentConfig | None = None,
          runs: Runs | None = None, buckets: int | None = None) -> dict:
    """Write all models as one run and switch readers to it.

    ``buckets``: files of the bucketed models; by default as many as shuffle
    partitions, so that they join with each other and with shuffled data alike;
    0 leaves these models lazy.
    """
    runs = runs or Runs(spark)
    run_id = run_id or runs.new()
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    root = runs.path(run_id)
    keep = _Materialized(spark, root, run_id, buckets)
    m = Models(sources, keep=keep)
    e = ExperimentModels(m, cfg)
    built: dict[str, DataFrame] = {}
    try:
        for name in VIEWS + TABLES:
            built[name] = getattr(m, name) if hasattr(m, name) else getattr(e, name)
    except Exception:
        _forget(spark, run_id)
        runs.remove(run_id)
        raise
    runs.switch(run_id, TABLES)
    removed = runs.remove_old()
    for gone in removed:
        _forget(spark, gone)
    out = {"run_id": run_id, "root": root, "models": built, "paths": dict(keep.paths),
           "removed": removed, "bucketed": {n: f"{keep.prefix}_{n}" for n in BUCKETED if buckets}}
    if run_checks:
        out["checks"] = quality.suite_with_bounds(built)
    return out


def build_from_tpch(spark: SparkSession, sf_dir: str, **kw) -> dict:
    return build(spark, from_tpch(TableSource(spark, sf_dir)), **kw)


def build_from_tables(spark: SparkSession, root: str, **kw) -> dict:
    """Shop-schema source tables stored under ``root`` (or catalog names)."""
    return build(spark, from_tables(TableSource(spark, root)), **kw)
