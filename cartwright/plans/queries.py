"""Query registry: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the raw TPC-H tables under ``sf_dir`` through the fixture
adapter and runs the full model chain it depends on, so its work grows with
the input. No query collects; the caller decides how to consume the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwright.operators.analytics import sorted_mart
from cartwright.operators.experiment import ExperimentConfig
from cartwright.plans.models import ExperimentModels, Models
from cartwright.sources.shop import RetailSources

_CACHE: dict[tuple[int, str], tuple] = {}


def models_for(spark: SparkSession, sf_dir: str) -> tuple[Models, ExperimentModels]:
    """Model graphs over ``sf_dir``; plans are shared within one live session.

    The entry remembers the session object and its application id, so a
    stopped session (or a new one that happens to reuse the object id) never
    gets DataFrames bound to another SparkContext.
    """
    key = (id(spark), sf_dir)
    app = spark.sparkContext.applicationId
    hit = _CACHE.get(key)
    if hit is None or hit[0] is not spark or hit[1] != app:
        m = Models.from_tpch_dir(spark, sf_dir)
        hit = (spark, app, m, ExperimentModels(m))
        _CACHE[key] = hit
    return hit[2], hit[3]


def register_models(spark: SparkSession, root: str, sources: RetailSources,
                    cfg: ExperimentConfig | None = None) -> None:
    """Let the queries over ``root`` read these sources under this configuration."""
    m = Models(sources)
    _CACHE[(id(spark), root)] = (spark, spark.sparkContext.applicationId, m,
                                 ExperimentModels(m, cfg))


def _exp(fn: Callable[[ExperimentModels], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(models_for(spark, sf_dir)[1])
    return run


def _shop(fn: Callable[[Models], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(models_for(spark, sf_dir)[0])
    return run


def _attr(name: str):
    return lambda m: getattr(m, name)


MODEL_QUERIES = [
    "stg_users", "stg_orders", "stg_order_items", "stg_products",
    "stg_experiment_assignments",
    "dim_users", "dim_orders", "dim_products", "fct_order_items",
    "mart_category_performance", "mart_customer_retention", "mart_channel_performance",
]

EXPERIMENT_QUERIES = [
    "fct_experiment_results",
    "baseline_order_value", "baseline_return_rate", "baseline_daily_orders",
    "sample_size_and_duration",
    "conversion_ztest", "aov_welch", "return_guardrail", "experiment_decision",
    "interval_chart",
]


DQ_MATERIALIZED = {
    # the two models that scan and join lineitem: written once, every other
    # model of the suite is planned on top of the compact written tables
    "stg_orders", "stg_order_items",
}


def dq_models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every model the checks read, heavy ones materialized once."""
    import uuid

    from cartwright.operators.quality import ALL_CHECKS
    from cartwright.plans.models import writing
    from cartwright.session import delete_at_end, warehouse_path
    root = warehouse_path(spark, "dq", uuid.uuid4().hex[:12])
    delete_at_end(spark, root)
    shop, experiment = models_for(spark, sf_dir)
    m = Models(shop.sources, keep=writing(DQ_MATERIALIZED, root))
    e = ExperimentModels(m, experiment.cfg)
    names = sorted({c.model for c in ALL_CHECKS} | {c.parent for c in ALL_CHECKS if c.parent}
                   | {"mart_category_performance", "mart_customer_retention",
                      "mart_channel_performance"})
    return {n: getattr(m, n) if hasattr(m, n) else getattr(e, n) for n in names}


def baseline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three baselines in one row, read from the catalog by full table names (SC3)."""
    import hashlib

    from cartwright.functions.scalars import with_scalars
    from cartwright.sources.shop import from_tables
    from cartwright.sources.tables import TableSource, publish
    shop, experiment = models_for(spark, sf_dir)
    src = shop.sources
    namespace = "shop_" + hashlib.md5(sf_dir.encode()).hexdigest()[:12]
    names = publish({"users": src.users, "orders": src.orders, "order_items": src.item_lines,
                     "products": src.products}, namespace)
    e = ExperimentModels(Models(from_tables(TableSource(spark), names)), experiment.cfg)
    return with_scalars(with_scalars(e.baseline_order_value, e.baseline_return_rate),
                        e.baseline_daily_orders)


def _variant_summary_display(e: ExperimentModels) -> DataFrame:
    from cartwright.functions.formatting import money, percent
    from cartwright.operators.experiment import variant_summary
    s = variant_summary(e.fct_experiment_results, e.cfg)
    return s.select("variant", "orders",
                    money(F.col("avg_order_value")).alias("avg_order_value"),
                    money(F.col("median_order_value")).alias("median_order_value"),
                    money(F.col("std_order_value")).alias("std_order_value"),
                    percent(F.col("conversion_rate")).alias("conversion_rate"),
                    percent(F.col("return_rate")).alias("return_rate"))


def _extra() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from cartwright.operators import calendar as K
    from cartwright.operators import charts as C
    from cartwright.operators import dashboard as D
    from cartwright.operators import experiment as X
    from cartwright.operators import quality as Q
    from cartwright.operators import statistics as S

    def fct(e):
        return e.fct_experiment_results
    return {
        "variant_balance": _exp(lambda e: X.variant_balance(fct(e))),
        "variant_summary": _exp(lambda e: X.variant_summary(fct(e), e.cfg)),
        "null_profile": _exp(lambda e: X.null_profile(fct(e))),
        "experiment_preview": _exp(lambda e: X.preview(fct(e))),
        "category_top10": _shop(lambda m: C.category_top10(m.mart_category_performance)),
        "headline_figures": _shop(lambda m: C.headline_figures(
            m.mart_category_performance, m.mart_customer_retention, m.mart_channel_performance)),
        "retention_line": _shop(lambda m: C.retention_line(m.mart_customer_retention)),
        "channel_bars": _shop(lambda m: C.channel_bars(m.mart_channel_performance)),
        "order_value_histogram": _exp(lambda e: C.order_value_histogram(fct(e))),
        "order_value_boxplot": _exp(lambda e: C.order_value_boxplot(fct(e), e.cfg.quantiles)),
        "order_value_outliers": _exp(lambda e: C.order_value_outliers(fct(e), e.cfg.quantiles)),
        "date_dimension": _exp(lambda e: K.date_dimension(fct(e))),
        "orders_by_calendar": _exp(lambda e: K.orders_by_calendar(fct(e))),
        "dashboard_cards": _exp(lambda e: D.dashboard_cards(fct(e))),
        "calendar_drilldown": _exp(lambda e: K.calendar_drilldown(fct(e))),
        "dashboard_cube": _exp(lambda e: D.measure_cube(fct(e))),
        "dashboard_filtered_cards": _exp(lambda e: D.filtered_cards(fct(e))),
        "dashboard_by_variant": _exp(lambda e: D.dashboard_by_variant(fct(e))),
        "variant_summary_display": _exp(_variant_summary_display),
        "experiment_report_display": _exp(lambda e: S.experiment_report_display(
            X.variant_balance(fct(e)), e.tests)),
        "headline_display": _shop(lambda m: C.headline_display(C.headline_figures(
            m.mart_category_performance, m.mart_customer_retention, m.mart_channel_performance))),
        "baseline_metrics": baseline_metrics,
        "dq_bounds_tight": _shop(lambda m: Q.rate_bounds(
            m.mart_category_performance, m.mart_customer_retention, m.mart_channel_performance,
            Q.USUAL_BOUNDS)),
        "dq_rate_bounds": _shop(lambda m: Q.rate_bounds(
            m.mart_category_performance, m.mart_customer_retention, m.mart_channel_performance)),
        "dq_results": lambda spark, sf_dir: Q.suite_with_bounds(dq_models(spark, sf_dir)),
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    reg: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for name in MODEL_QUERIES:
        reg[name] = _shop(lambda m, n=name: sorted_mart(n, getattr(m, n)))
    for name in EXPERIMENT_QUERIES:
        reg[name] = _exp(_attr(name))
    reg.update(_extra())
    return reg
