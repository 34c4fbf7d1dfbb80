"""Experiment models: the per-order fact, balance, summary, baselines, power.

Everything below the fact is an aggregate of the fact (or of the raw orders
and items), computed as a DataFrame job; only one-row or per-variant
results are produced, and none is collected.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from cartwright.functions.distributions import normal_quantile
from cartwright.functions.hashing import CONTROL, TREATMENT
from cartwright.functions.moments import deviation, exact_sum, mean, sums, variance
from cartwright.functions.numeric import flag, safe_divide
from cartwright.functions.scalars import with_scalars
from cartwright.operators.quantiles import quantile_columns


@dataclass(frozen=True)
class ExperimentConfig:
    """Parameters of the free-shipping banner test.

    The reference hard-codes a four-week window; the test data spans
    1995-2001, so the default window is the year 1998 (see FIXTURES.md).
    """

    start: dt.date = dt.date(1998, 1, 1)
    end: dt.date = dt.date(1998, 12, 31)
    statuses: tuple[str, ...] = ("Complete", "Returned")
    alpha: float = 0.05
    power: float = 0.80
    mde_relative: float = 0.05
    guardrail: float = 0.03
    traffic_share: float = 0.5
    quantiles: str = "exact"          # or "approx" (percentile_approx sketch)
    variants: tuple[str, ...] = field(default=(CONTROL, TREATMENT))


DEFAULT = ExperimentConfig()


# -- the fact ----------------------------------------------------------------

def fct_experiment_results(assignments: DataFrame, orders: DataFrame, order_items: DataFrame,
                           cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """One row per order in the test window with a final status.

    ``orders`` / ``order_items`` are the staging models (same projections as
    the raw sources). The basket value covers all items of the order,
    whatever their status. Items are first semi-joined to the qualifying
    orders, so the basket aggregate never touches items of other orders;
    that is exact because the basket is inner-joined to those orders anyway.
    """
    o = (orders
         # a range on the column itself, so that it reaches the scan
         .where((F.col("created_at") >= F.lit(cfg.start).cast("date"))
                & (F.col("created_at") < F.date_add(F.lit(cfg.end).cast("date"), 1))
                & F.col("status").isin(*cfg.statuses))
         .select("order_id", "user_id", F.col("status").alias("order_status"),
                 F.col("created_at").alias("order_created_at")))
    items = order_items.select("order_id", "sale_price").join(
        o.select("order_id"), on="order_id", how="left_semi")
    order_values = (items.groupBy("order_id")
                    .agg(exact_sum(F.col("sale_price")).alias("order_value"),
                         F.count(F.lit(1)).alias("item_count")))
    a = assignments.select(F.col("user_id").alias("a_user_id"), "variant")
    j = (o.join(order_values, on="order_id", how="inner")
          .join(a, F.col("user_id") == F.col("a_user_id"), "inner"))
    return j.select(
        "order_id", "user_id", "variant", "order_status", "order_created_at",
        "order_value", "item_count",
        flag(F.col("order_status") == "Complete").alias("is_completed"),
        flag(F.col("order_status") == "Returned").alias("is_returned"))


# -- exploratory -----------------------------------------------------------

def _known_variant(fct: DataFrame) -> DataFrame:
    # pandas groupby drops NULL keys; keep that behaviour explicitly
    return fct.where(F.col("variant").isNotNull())


def variant_balance(fct: DataFrame) -> DataFrame:
    """Orders, distinct users and share of orders (percent, 1 digit) per variant.

    One read of the fact: a ROLLUP gives the variants and, as the row with
    ``grouping_id`` 1, the total. These few rows are put in one list, from which
    each variant takes the total.
    """
    levels = (_known_variant(fct).rollup("variant")
              .agg(F.count("order_id").alias("orders"), F.countDistinct("user_id").alias("users"),
                   F.grouping_id().alias("level")))
    rows = levels.agg(
        F.max(F.when(F.col("level") == 1, F.col("orders"))).alias("total"),
        F.collect_list(F.when(F.col("level") == 0, F.struct("variant", "orders", "users"))).alias("v"))
    share = safe_divide(F.col("orders"), F.col("total"))
    return rows.select("total", F.explode("v").alias("v")).select("v.*", "total").select(
        "variant", "orders", "users", F.bround(share * 100, 1).alias("pct_orders"),
        share.alias("share_orders"))


def variant_summary(fct: DataFrame, cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """Count, mean, median, sample sd, conversion and return rate per variant."""
    f = _known_variant(fct)
    base = (f.groupBy("variant")
            .agg(F.count("order_id").alias("orders"), *sums(F.col("order_value"), "v"),
                 F.avg("is_completed").alias("conversion_rate"),
                 F.avg("is_returned").alias("return_rate"))
            .withColumns({"avg_order_value": mean("v"), "std_order_value": deviation("v")}))
    med = quantile_columns(cfg.quantiles)(f, ["variant"], "order_value", [0.5],
                                           names=["median_order_value"])
    j = base.join(med, on="variant", how="left")
    return j.select("variant", "orders",
                    F.round("avg_order_value", 4).alias("avg_order_value"),
                    F.round("median_order_value", 4).alias("median_order_value"),
                    F.round("std_order_value", 4).alias("std_order_value"),
                    F.round("conversion_rate", 6).alias("conversion_rate"),
                    F.round("return_rate", 6).alias("return_rate"))


def preview(fct: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` orders by id (the notebook's head(); the limit is the feature).

    Planned as a top-k (TakeOrderedAndProject): each task keeps n rows.
    """
    return fct.orderBy("order_id").limit(n)


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: NULL count, Spark type, and the frame's row/column counts.

    One aggregation pass computes every column's NULL count; the result is
    unpivoted into one row per column.
    """
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    types = dict(df.dtypes)
    entries = F.array(*[F.struct(F.lit(i).alias("column_position"),
                                 F.lit(c).alias("column_name"),
                                 F.lit(types[c]).alias("data_type"),
                                 F.col(f"_n{i}").alias("null_count"))
                        for i, c in enumerate(cols)])
    return (wide.select(F.col("_rows").alias("row_count"),
                        F.lit(len(cols)).cast("bigint").alias("column_count"),
                        F.explode(entries).alias("_e"))
                .select("_e.column_position", "_e.column_name", "_e.data_type",
                        "_e.null_count", "row_count", "column_count"))


# -- baselines (pre-test) --------------------------------------------------

def baseline_order_value(order_items: DataFrame) -> DataFrame:
    """Mean, sample sd and count of per-order sums over completed items."""
    per_order = (order_items.where(F.col("status") == "Complete")
                 .groupBy("order_id").agg(exact_sum(F.col("sale_price")).alias("order_value")))
    return (per_order.agg(*sums(F.col("order_value"), "v"), F.count(F.lit(1)).alias("order_count"))
            .select(F.round(mean("v"), 2).alias("baseline_aov"),
                    F.round(deviation("v"), 2).alias("aov_stddev"), "order_count"))


def baseline_return_rate(orders: DataFrame) -> DataFrame:
    """Share of final-status orders that were returned (NULL on no orders)."""
    o = orders.where(F.col("status").isin("Complete", "Returned"))
    return o.agg(
        F.round(safe_divide(F.count_if(F.col("status") == "Returned"), F.count(F.lit(1))), 4)
        .alias("baseline_return_rate"),
        F.count(F.lit(1)).alias("total_orders"))


def baseline_daily_orders(orders: DataFrame) -> DataFrame:
    """Mean over days of distinct completed orders per (UTC) day."""
    per_day = (orders.where(F.col("status") == "Complete")
               .groupBy(F.to_date("created_at").alias("order_date"))
               .agg(F.countDistinct("order_id").alias("daily_orders")))
    return per_day.agg(F.avg("daily_orders").alias("avg_daily_orders"))


def sample_size_and_duration(baseline_value: DataFrame, daily: DataFrame,
                             cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """n = 2 sd^2 (z_a + z_b)^2 / mde^2 per variant, and days of traffic needed.

    The normal quantiles depend on parameters only and enter as literals.
    """
    z_a = normal_quantile(1 - cfg.alpha / 2)
    z_b = normal_quantile(cfg.power)
    b = with_scalars(baseline_value, daily)
    mde = F.col("baseline_aov") * F.lit(cfg.mde_relative)
    # NULL (not an ANSI error) when the baseline AOV is 0 or missing
    n = safe_divide(F.lit(2.0) * F.col("aov_stddev") * F.col("aov_stddev") * F.lit((z_a + z_b) ** 2),
                    mde * mde)
    n_per = F.ceil(n).cast("bigint")
    days = safe_divide(n_per.cast("double"), F.col("avg_daily_orders") * F.lit(cfg.traffic_share))
    return b.select(
        "baseline_aov", "aov_stddev",
        F.round(mde, 6).alias("mde_absolute"),
        F.round(safe_divide(mde, F.col("aov_stddev")), 6).alias("effect_size"),
        F.lit(round(z_a, 12)).alias("z_alpha"),
        F.lit(round(z_b, 12)).alias("z_beta"),
        F.round(n, 4).alias("n_exact"),
        n_per.alias("n_per_variant"),
        (n_per * 2).alias("n_total"),
        F.round("avg_daily_orders", 6).alias("avg_daily_orders"),
        F.round(days, 4).alias("duration_days"),
        F.ceil(days).cast("bigint").alias("duration_days_ceil"))


# -- per-variant moments feeding every test --------------------------------

def variant_moments(fct: DataFrame, cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """One row: counts, successes, means and variances of control and treatment.

    A single global aggregation with conditional aggregates: each task
    pre-aggregates, the final merge sees one row per task. Order values enter as
    exact sums, so the row is the same in every run.
    """
    out, shown = [], []
    for tag, v in (("c", cfg.variants[0]), ("t", cfg.variants[1])):
        is_v = F.col("variant") == v
        out += [
            F.count_if(is_v).alias(f"n_{tag}"),
            F.sum(F.when(is_v, F.col("is_completed"))).cast("bigint").alias(f"conv_{tag}"),
            F.sum(F.when(is_v, F.col("is_returned"))).cast("bigint").alias(f"ret_{tag}"),
            *sums(F.when(is_v, F.col("order_value")), f"value_{tag}"),
        ]
        shown += [F.col(f"n_{tag}"), F.col(f"conv_{tag}"), F.col(f"ret_{tag}"),
                  mean(f"value_{tag}").alias(f"mean_{tag}"),
                  variance(f"value_{tag}").alias(f"var_{tag}")]
    return fct.agg(*out).select(*shown)
