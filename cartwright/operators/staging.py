"""Staging models: one projection per source table (PR1-PR4, PR8-PR10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartwright.functions.hashing import variant_key, variant_of


def stg_users(users: DataFrame) -> DataFrame:
    return users.select(
        F.col("id").alias("user_id"), "first_name", "last_name", "email", "age",
        "gender", "city", "state", "country", "traffic_source",
        F.col("created_at").alias("user_created_at"))


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", "user_id", "status", "gender", "created_at",
                         "returned_at", "shipped_at", "delivered_at", "num_of_item")


def stg_order_items(order_items: DataFrame) -> DataFrame:
    return order_items.select(
        F.col("id").alias("order_item_id"), "order_id", "user_id", "product_id", "status",
        "created_at", "shipped_at", "delivered_at", "returned_at", "sale_price")


def stg_products(products: DataFrame) -> DataFrame:
    return products.select(
        F.col("id").alias("product_id"), F.col("name").alias("product_name"), "brand",
        "category", "department", "cost", "retail_price")


def stg_experiment_assignments(users: DataFrame) -> DataFrame:
    """Every user gets a variant from a deterministic hash of the id.

    One row per user; a user keeps the variant for all of their orders.
    """
    key = variant_key(F.col("id"))
    return users.select(
        F.col("id").alias("user_id"),
        F.col("created_at").alias("user_created_at"),
        "country", "age", "gender",
        variant_of(key).alias("variant"),
        key.alias("variant_key"))
