"""Dashboard measures (AG20-AG26, FI8-FI10, SC8).

Card measures are conditional aggregates (``CALCULATE(agg, variant = x)``)
in one pass over the fact; the variant charts are a group-by. The optional
``variants`` filter mirrors the visual-level filter slots (none by default).

``measure_cube`` answers any filter context at once: the fact is reduced to
mergeable states (counts and exact sums) of each variant, status and month, and
a CUBE merges these few rows for every combination of filters. A card under a
filter is one cell of it (``cell``), so no filter needs another pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartwright.functions.hashing import CONTROL, TREATMENT
from cartwright.functions.moments import mean, merged, sums
from cartwright.functions.numeric import safe_divide

#: the axes of the cube; a cell without a filter on an axis has ``ALL`` there
AXES = ("variant", "order_status", "order_month")
ALL = "all"


def _filtered(fct: DataFrame, variants: list[str] | None) -> DataFrame:
    return fct.where(F.col("variant").isin(*variants)) if variants else fct


def dashboard_cards(fct: DataFrame, variants: list[str] | None = None) -> DataFrame:
    f = _filtered(fct, variants)
    out, shown = [], []
    for v in (CONTROL, TREATMENT):
        is_v = F.col("variant") == v
        out += [F.count_if(is_v).alias(f"{v}_orders"),
                *sums(F.when(is_v, F.col("order_value")), v),
                F.avg(F.when(is_v, F.col("is_completed"))).alias(f"{v}_completed")]
        shown += [F.col(f"{v}_orders"), F.round(mean(v), 4).alias(f"{v}_aov"),
                  F.round(f"{v}_completed", 6).alias(f"{v}_conv_rate")]
    return f.agg(*out).select(*shown)


def dashboard_by_variant(fct: DataFrame, variants: list[str] | None = None) -> DataFrame:
    return (_filtered(fct, variants).groupBy("variant")
            .agg(F.count(F.lit(1)).alias("orders"), *sums(F.col("order_value"), "v"),
                 F.round(F.avg("is_completed"), 6).alias("conversion_rate"))
            .select("variant", "orders", F.round(mean("v"), 4).alias("aov"), "conversion_rate"))


def measure_states(fct: DataFrame) -> DataFrame:
    """Mergeable states by variant, status and month ('yyyy-MM'): a row for each combination."""
    return (fct.where(F.col("variant").isNotNull())
            .select("variant", "order_status",
                    F.date_format("order_created_at", "yyyy-MM").alias("order_month"),
                    "order_value", "is_completed", "is_returned")
            .groupBy(*AXES)
            .agg(F.count(F.lit(1)).alias("orders"), *sums(F.col("order_value"), "v"),
                 F.sum("is_completed").alias("completed"), F.sum("is_returned").alias("returned")))


def measure_cube(fct: DataFrame) -> DataFrame:
    """Orders, order value, AOV, conversion and return rate in every filter context.

    One pass over the fact; the CUBE works on the states, whose number depends on
    variants, statuses and months alone. ``grouping_id`` tells a missing filter
    from a NULL value, which reads 'unknown'.
    """
    states = measure_states(fct)
    cells = states.cube(*AXES).agg(
        F.sum("orders").alias("orders"), *merged("v"), F.sum("completed").alias("completed"),
        F.sum("returned").alias("returned"),
        *[F.grouping(a).alias(f"open_{a}") for a in AXES])
    axis = lambda a: F.when(F.col(f"open_{a}") == 1, ALL).otherwise(
        F.coalesce(F.col(a), F.lit("unknown"))).alias(a)
    rate = lambda part: F.round(safe_divide(F.col(part), F.col("orders")), 6)
    return cells.select(
        *[axis(a) for a in AXES], "orders",
        F.round(F.col("s1_v").cast("double") / 10_000, 2).alias("order_value"),
        F.round(mean("v"), 4).alias("aov"), rate("completed").alias("conversion_rate"),
        rate("returned").alias("return_rate"))


def cell(cube: DataFrame, variant: str = ALL, status: str = ALL, month: str = ALL) -> DataFrame:
    """The measures under these filters (one row, none if no order passes them)."""
    return cube.where((F.col("variant") == variant) & (F.col("order_status") == status)
                      & (F.col("order_month") == month))


def filtered_cards(fct: DataFrame) -> DataFrame:
    """The cards of the dashboard under every choice of its variant filter.

    Rows: the filter (no filter, each variant); a card of a variant that the filter
    leaves out has 0 orders and no rates, as the visual shows it. All cards are
    cells of one cube.
    """
    cube = measure_cube(fct).where((F.col("order_status") == ALL) & (F.col("order_month") == ALL))
    cells = cube.where(F.col("variant") != ALL).agg(F.collect_list(F.struct(
        "variant", "orders", "aov", "conversion_rate")).alias("cells"))
    chosen = F.explode(F.concat(F.array(F.lit(ALL)), F.array_sort(F.transform(
        "cells", lambda c: c["variant"]))))
    rows = cells.select("cells", chosen.alias("variant_filter"))
    def of(v: str) -> Column:
        return F.get(F.filter("cells", lambda c: c["variant"] == v), 0)

    out = [F.col("variant_filter")]
    for v in (CONTROL, TREATMENT):
        passes, own = F.col("variant_filter").isin(ALL, v), of(v)
        out += [F.coalesce(F.when(passes, own["orders"]), F.lit(0)).alias(f"{v}_orders"),
                F.when(passes, own["aov"]).alias(f"{v}_aov"),
                F.when(passes, own["conversion_rate"]).alias(f"{v}_conv_rate")]
    return rows.select(*out)
