"""Date dimension for the dashboard (DD1, DD2, JN7, FN15-FN17).

The calendar runs from 1 January of the first order's year to 31 December
of the last order's year: one aggregate (min, max) over the fact, then a
``sequence`` of days exploded into rows. Its size is bounded by the year
span, not by the number of orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartwright.functions.moments import mean, merged, sums
from cartwright.functions.numeric import safe_divide


def calendar_parts(d: Column) -> list[Column]:
    """Year, MonthNo, Month name, QuarterNo, 'Qtr n', Day for a date column."""
    quarter_no = F.floor((F.month(d) + 2) / 3).cast("int")
    return [F.year(d).alias("year"),
            F.month(d).alias("month_no"),
            F.date_format(d, "MMMM").alias("month"),
            quarter_no.alias("quarter_no"),
            F.concat(F.lit("Qtr "), quarter_no.cast("string")).alias("quarter"),
            F.dayofmonth(d).alias("day")]


def date_dimension(fct: DataFrame, ts_col: str = "order_created_at") -> DataFrame:
    bounds = fct.agg(F.year(F.min(ts_col)).alias("y1"), F.year(F.max(ts_col)).alias("y2"))
    days = bounds.select(F.explode(F.sequence(
        F.make_date(F.col("y1"), F.lit(1), F.lit(1)),
        F.make_date(F.col("y2"), F.lit(12), F.lit(31)),
        F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.select("date", *calendar_parts(F.col("date")))


def orders_by_calendar(fct: DataFrame, ts_col: str = "order_created_at") -> DataFrame:
    """Orders, AOV and conversion of every calendar day, days without orders included.

    The generated calendar is joined with the orders of each day; both sides
    have one row per day, so the join is as small as the result.
    """
    daily = (daily_states(fct, ts_col)
             .select("date", F.col("orders").alias("n"), F.round(mean("v"), 4).alias("aov"),
                     F.round(safe_divide(F.col("completed"), F.col("orders")), 6)
                     .alias("conversion_rate")))
    return (date_dimension(fct, ts_col).join(daily, "date", "left")
            .select("date", "year", "quarter_no", "quarter", "month_no", "month", "day",
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("orders"), "aov",
                    "conversion_rate"))


def daily_states(fct: DataFrame, ts_col: str = "order_created_at") -> DataFrame:
    """Mergeable sums of each day that has orders."""
    return (fct.groupBy(F.to_date(F.col(ts_col)).alias("date"))
            .agg(F.count(F.lit(1)).alias("orders"), *sums(F.col("order_value"), "v"),
                 F.sum("is_completed").alias("completed")))


#: the levels of the drill-down, from the top
LEVELS = ("year", "quarter_no", "month_no", "day")


def calendar_drilldown(fct: DataFrame, ts_col: str = "order_created_at") -> DataFrame:
    """Orders, AOV and conversion at every level of the date hierarchy (DD2).

    ``level`` is 0 for the total, 1 for years, ... 4 for days; the numbers below
    a level are 0 and the names NULL. One read of the fact: days are summed up first, and a
    ROLLUP over year, quarter, month and day merges their exact sums, told apart
    by ``grouping_id``. Rows come in the order of the numbers (May after April,
    not after August), each level before what it contains.
    """
    days = daily_states(fct, ts_col).where(F.col("date").isNotNull())
    parts = days.select("*", *calendar_parts(F.col("date")))
    levels = parts.rollup(*LEVELS).agg(
        F.sum("orders").alias("orders"), *merged("v"), F.sum("completed").alias("completed"),
        F.max("month").alias("_month"), F.grouping_id().alias("_id"))
    # grouping_id has one bit for each column that is rolled up: 15, 7, 3, 1, 0
    level = F.lit(len(LEVELS)) - F.bit_count("_id")
    number = lambda n: F.coalesce(F.col(n), F.lit(0)).alias(n)
    out = levels.withColumn("level", level.cast("int")).select(
        "level", number("year"), number("quarter_no"),
        F.when(F.col("level") >= 2, F.concat(F.lit("Qtr "), F.col("quarter_no").cast("string")))
        .alias("quarter"),
        number("month_no"), F.when(F.col("level") >= 3, F.col("_month")).alias("month"),
        number("day"), "orders",
        F.round(mean("v"), 4).alias("aov"),
        F.round(safe_divide(F.col("completed"), F.col("orders")), 6).alias("conversion_rate"))
    return out.orderBy(*LEVELS)
