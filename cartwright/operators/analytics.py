"""Analytics marts: category profit, cohort retention, channel value.

Each mart pre-aggregates at the finest key it needs (product, order, user)
before any join or coarse grouping, so a hot key (one product or one user
holding a large share of the rows) is collapsed by map-side partial
aggregation instead of landing in one task, and the join that follows
moves one row per key instead of one row per item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartwright.functions.numeric import flag, safe_divide


def mart_category_performance(fct_order_items: DataFrame, dim_products: DataFrame,
                              sort: bool = True) -> DataFrame:
    """Revenue, cost, margin, margin % and return rate per category x department.

    Cancelled items are excluded from sold figures; an item with a
    returned_at counts as returned whatever its status (so the return rate
    can exceed 1, which the rate-bounds check reports). A NULL status counts
    as sold.

    The item-level sums are taken per product first: cost is an attribute
    of the product, so cost and margin sums follow exactly from the item
    counts and price sums per product, including the SQL NULL rules (a NULL
    price or cost drops an item from the margin sum, a cancelled item adds 0).
    """
    status = F.col("status")
    cancelled = flag(status == "Cancelled")
    sold = cancelled == 0
    price = F.col("sale_price")
    per_product = (
        fct_order_items
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("n_items"),
             F.sum(cancelled).cast("bigint").alias("n_cancelled"),
             F.sum(flag(F.col("returned_at").isNotNull())).cast("bigint").alias("n_returned"),
             F.sum(F.when(sold, price).otherwise(F.lit(0.0))).alias("rev"),
             F.sum(F.when(sold, price)).alias("rev_nn"),
             F.count(F.when(sold, price)).alias("cnt_nn")))
    p = dim_products.select(F.col("product_id").alias("p_product_id"), "category",
                            "department", "cost")
    j = per_product.join(p, per_product.product_id == p.p_product_id, "inner")
    cost = F.col("cost")
    n_sold = F.col("n_items") - F.col("n_cancelled")
    has_cancelled = F.col("n_cancelled") > 0
    cogs = F.when(cost.isNull(), F.when(has_cancelled, F.lit(0.0))).otherwise(n_sold * cost)
    margin = (F.when(cost.isNotNull() & (F.col("cnt_nn") > 0),
                     F.col("rev_nn") - F.col("cnt_nn") * cost)
              .when(has_cancelled, F.lit(0.0)))
    parts = j.select("category", "department", "n_items", n_sold.alias("n_sold"),
                     "n_returned", "rev", cogs.alias("cogs"), margin.alias("margin"))
    out = (parts.groupBy("category", "department")
           .agg(F.sum("n_items").alias("items_ordered"),
                F.sum("n_sold").alias("items_sold"),
                F.sum("n_returned").alias("items_returned"),
                F.sum("rev").alias("_rev"),
                F.sum("cogs").alias("_cogs"),
                F.sum("margin").alias("_margin"))
           .select("category", "department", "items_ordered", "items_sold", "items_returned",
                   F.round("_rev", 2).alias("gross_revenue"),
                   F.round("_cogs", 2).alias("cost_of_goods"),
                   F.round("_margin", 2).alias("gross_margin"),
                   F.round(safe_divide(F.col("_margin"), F.col("_rev")), 4).alias("gross_margin_pct"),
                   F.round(safe_divide(F.col("items_returned"), F.col("items_sold")), 4).alias("return_rate")))
    return out.orderBy(F.col("gross_margin").desc()) if sort else out


def customer_lifetimes(dim_orders: DataFrame) -> DataFrame:
    """Per user: distinct non-cancelled orders and the first order time.

    ``count(distinct order_id)`` as two aggregation levels: (user, order)
    then user. The first shuffle is keyed by (user, order), so a user with
    a huge number of orders is spread over many tasks; the second level is
    partially aggregated before its shuffle.
    """
    o = dim_orders.where(F.col("status") != "Cancelled")
    per_order = (o.groupBy("user_id", "order_id")
                 .agg(F.min("order_created_at").alias("first_at")))
    return (per_order.groupBy("user_id")
            .agg(F.count("order_id").alias("lifetime_orders"),
                 F.min("first_at").alias("first_order_at")))


def mart_customer_retention(dim_orders: DataFrame, sort: bool = True) -> DataFrame:
    """Share of each monthly acquisition cohort that ordered twice or more."""
    cohorts = customer_lifetimes(dim_orders).select(
        F.trunc(F.to_date("first_order_at"), "month").alias("cohort_month"),
        flag(F.col("lifetime_orders") >= 2).alias("is_repeat_customer"))
    out = (cohorts.groupBy("cohort_month")
           .agg(F.count(F.lit(1)).alias("new_customers"),
                F.sum("is_repeat_customer").cast("bigint").alias("repeat_customers"))
           .withColumn("repeat_purchase_rate",
                       F.round(safe_divide(F.col("repeat_customers"), F.col("new_customers")), 4)))
    return out.orderBy("cohort_month") if sort else out


def user_order_totals(fct_order_items: DataFrame) -> DataFrame:
    """Per user over non-cancelled items: distinct orders and revenue."""
    items = fct_order_items.where(F.col("status") != "Cancelled")
    per_order = (items.groupBy("user_id", "order_id")
                 .agg(F.sum("sale_price").alias("order_revenue")))
    return (per_order.groupBy("user_id")
            .agg(F.count("order_id").alias("lifetime_orders"),
                 F.sum("order_revenue").alias("lifetime_revenue")))


def mart_channel_performance(dim_users: DataFrame, fct_order_items: DataFrame,
                             sort: bool = True) -> DataFrame:
    """Customers, orders, revenue, per-customer values and repeat rate per channel.

    Users without a non-cancelled item stay in (left join) with 0 orders,
    0 revenue and not repeat.
    """
    per_user = user_order_totals(fct_order_items).withColumnRenamed("user_id", "p_user_id")
    u = dim_users.select("user_id", "traffic_source")
    j = u.join(per_user, u.user_id == per_user.p_user_id, "left")
    user_level = j.select(
        "traffic_source",
        F.coalesce(F.col("lifetime_orders"), F.lit(0).cast("bigint")).alias("lifetime_orders"),
        F.coalesce(F.col("lifetime_revenue"), F.lit(0.0)).alias("lifetime_revenue"),
        flag(F.col("lifetime_orders") >= 2).alias("is_repeat_customer"))
    agg = (user_level.groupBy("traffic_source")
           .agg(F.count(F.lit(1)).alias("customers"),
                F.sum("lifetime_orders").alias("total_orders"),
                F.sum("lifetime_revenue").alias("_revenue"),
                F.sum("is_repeat_customer").alias("_repeat")))
    out = agg.select(
        "traffic_source", "customers", "total_orders",
        F.round("_revenue", 2).alias("total_revenue"),
        F.round(safe_divide(F.col("_revenue"), F.col("customers")), 2).alias("revenue_per_customer"),
        F.round(safe_divide(F.col("total_orders"), F.col("customers")), 2).alias("orders_per_customer"),
        F.round(safe_divide(F.col("_repeat"), F.col("customers")), 4).alias("repeat_purchase_rate"))
    return out.orderBy(F.col("total_revenue").desc()) if sort else out


# reference ORDER BY of each mart, applied when the mart is read for display
SORT_ORDER = {
    "mart_category_performance": [("gross_margin", "desc")],
    "mart_customer_retention": [("cohort_month", "asc")],
    "mart_channel_performance": [("total_revenue", "desc")],
}


def sorted_mart(name: str, df: DataFrame) -> DataFrame:
    if name not in SORT_ORDER:
        return df
    return df.orderBy(*[getattr(F.col(c), d)() for c, d in SORT_ORDER[name]])
