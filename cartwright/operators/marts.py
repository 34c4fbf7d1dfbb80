"""Star schema: three dimensions and the order-item fact (PR5-PR7, JN1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def dim_users(stg_users: DataFrame) -> DataFrame:
    """User dimension without the e-mail address (personal data)."""
    return stg_users.select("user_id", "first_name", "last_name", "age", "gender", "city",
                            "state", "country", "traffic_source", "user_created_at")


def dim_orders(stg_orders: DataFrame) -> DataFrame:
    return stg_orders.select("order_id", "user_id", "status", "gender",
                             F.col("created_at").alias("order_created_at"),
                             "returned_at", "shipped_at", "delivered_at", "num_of_item")


def dim_products(stg_products: DataFrame) -> DataFrame:
    return stg_products.select("product_id", "product_name", "brand", "category",
                               "department", "cost", "retail_price")


def fct_order_items(stg_order_items: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """One row per item, with the order's item count (left join on order_id).

    A duplicated order header fans the item out, as the SQL left join does.
    When the order side is known unique on order_id and num_of_item is not
    read downstream, Catalyst removes this join from the plan.
    """
    o = stg_orders.select(F.col("order_id").alias("o_order_id"), "num_of_item")
    j = stg_order_items.join(o, stg_order_items.order_id == o.o_order_id, "left")
    return j.select("order_item_id", "order_id", "user_id", "product_id", "status",
                    "created_at", "shipped_at", "delivered_at", "returned_at",
                    "sale_price", "num_of_item")
