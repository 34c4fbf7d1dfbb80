"""The model graph: sources -> staging -> star schema -> marts.

Marts are stored unsorted; a read that wants the reference's order sorts
(``analytics.SORT_ORDER``), so downstream jobs never pay for a sort whose
order they discard.

``Models`` wires the operator functions together the way the reference's
model references do; every attribute is a lazy DataFrame built on first use,
so a query only plans the models it reads and Catalyst optimizes the whole
chain as one plan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from cartwright.operators import analytics, marts, staging
from cartwright.sources.tables import TableSource
from cartwright.sources.shop import RetailSources, from_tpch


def writing(names: set[str], root: str):
    """A ``keep`` hook that writes the named models as Parquet under ``root``
    (a folder in the shared checkpoint location) and reads them back.

    Each model is computed once and the lineage is cut (a lost executor
    costs a re-read, not a recomputation from the raw sources); later reads
    are columnar, so a check on one column reads one column.
    """
    from cartwright.sources.sinks import write_table

    def keep(name: str, df: DataFrame) -> DataFrame:
        return write_table(df, f"{root}/{name}") if name in names else df
    return keep


def _identity(name: str, df: DataFrame) -> DataFrame:
    return df


class Models:
    def __init__(self, sources: RetailSources, keep=None):
        self.sources = sources
        self._k = keep or _identity

    @classmethod
    def from_tpch_dir(cls, spark: SparkSession, sf_dir: str, keep=None) -> "Models":
        return cls(from_tpch(TableSource(spark, sf_dir)), keep)

    # staging (views)
    @cached_property
    def stg_users(self) -> DataFrame:
        return self._k("stg_users", staging.stg_users(self.sources.users))

    @cached_property
    def stg_orders(self) -> DataFrame:
        return self._k("stg_orders", staging.stg_orders(self.sources.orders))

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return self._k("stg_order_items", staging.stg_order_items(self.sources.order_items))

    @cached_property
    def stg_products(self) -> DataFrame:
        return self._k("stg_products", staging.stg_products(self.sources.products))

    @cached_property
    def stg_experiment_assignments(self) -> DataFrame:
        return self._k("stg_experiment_assignments", staging.stg_experiment_assignments(self.sources.users))

    @cached_property
    def item_lines(self) -> DataFrame:
        """Staged order items without their order's columns, for models that read none."""
        return self._k("item_lines", self.sources.item_lines.withColumnRenamed("id", "order_item_id"))

    # star schema (tables)
    @cached_property
    def dim_users(self) -> DataFrame:
        return self._k("dim_users", marts.dim_users(self.stg_users))

    @cached_property
    def dim_orders(self) -> DataFrame:
        return self._k("dim_orders", marts.dim_orders(self.stg_orders))

    @cached_property
    def dim_products(self) -> DataFrame:
        return self._k("dim_products", marts.dim_products(self.stg_products))

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return self._k("fct_order_items", marts.fct_order_items(self.stg_order_items, self.stg_orders))

    # analytics marts (tables)
    @cached_property
    def mart_category_performance(self) -> DataFrame:
        return self._k("mart_category_performance", analytics.mart_category_performance(self.item_lines, self.dim_products, sort=False))

    @cached_property
    def mart_customer_retention(self) -> DataFrame:
        return self._k("mart_customer_retention", analytics.mart_customer_retention(self.dim_orders, sort=False))

    @cached_property
    def mart_channel_performance(self) -> DataFrame:
        return self._k("mart_channel_performance", analytics.mart_channel_performance(self.dim_users, self.fct_order_items, sort=False))


class ExperimentModels:
    """The experiment chain on top of the shop models."""

    def __init__(self, models: Models, cfg=None):
        from cartwright.operators.experiment import DEFAULT
        self.m = models
        self.cfg = cfg or DEFAULT
        self._k = models._k

    @cached_property
    def fct_experiment_results(self) -> DataFrame:
        from cartwright.operators.experiment import fct_experiment_results
        return self._k("fct_experiment_results", fct_experiment_results(
            self.m.stg_experiment_assignments, self.m.stg_orders, self.m.item_lines, self.cfg))

    @cached_property
    def moments(self) -> DataFrame:
        from cartwright.operators.experiment import variant_moments
        return variant_moments(self.fct_experiment_results, self.cfg)

    @cached_property
    def baseline_order_value(self) -> DataFrame:
        from cartwright.operators.experiment import baseline_order_value
        return baseline_order_value(self.m.item_lines)

    @cached_property
    def baseline_return_rate(self) -> DataFrame:
        from cartwright.operators.experiment import baseline_return_rate
        return baseline_return_rate(self.m.stg_orders)

    @cached_property
    def baseline_daily_orders(self) -> DataFrame:
        from cartwright.operators.experiment import baseline_daily_orders
        return baseline_daily_orders(self.m.stg_orders)

    @cached_property
    def sample_size_and_duration(self) -> DataFrame:
        from cartwright.operators.experiment import sample_size_and_duration
        return sample_size_and_duration(self.baseline_order_value, self.baseline_daily_orders,
                                        self.cfg)

    @cached_property
    def conversion_ztest(self) -> DataFrame:
        from cartwright.operators.statistics import conversion_ztest
        return conversion_ztest(self.moments, self.cfg)

    @cached_property
    def aov_welch(self) -> DataFrame:
        from cartwright.operators.statistics import aov_welch
        return aov_welch(self.moments, self.cfg)

    @cached_property
    def return_guardrail(self) -> DataFrame:
        from cartwright.operators.statistics import return_guardrail
        return return_guardrail(self.moments, self.cfg)

    @cached_property
    def tests(self) -> DataFrame:
        """All test statistics as one row over one aggregate of the fact."""
        from cartwright.operators.statistics import all_tests
        return all_tests(self.moments, self.cfg)

    @cached_property
    def experiment_decision(self) -> DataFrame:
        from cartwright.operators.statistics import decision
        return decision(self.tests, self.sample_size_and_duration, self.cfg)

    @cached_property
    def interval_chart(self) -> DataFrame:
        from cartwright.operators.statistics import intervals
        return intervals(self.tests, self.cfg)
