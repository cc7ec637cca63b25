"""Staging: current-state tables under the names the star schema uses.  Plain projections, never stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stg_users(users: DataFrame) -> DataFrame:
    return users.select(F.col("id").alias("user_id"), "name", "email", "city", "registered_at")


def stg_products(products: DataFrame) -> DataFrame:
    return products.select(F.col("id").alias("product_id"), "name", "category", "price", "stock")


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("id").alias("order_id"), "user_id", "order_date", "status", "total_amount")


def stg_order_items(order_items: DataFrame) -> DataFrame:
    return order_items.select(F.col("id").alias("order_item_id"), "order_id", "product_id", "quantity", "price")


def stg_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        F.col("id").alias("payment_id"), "order_id", "payment_method", "amount", "status", "paid_at"
    )


def stg_clickstream(clickstream: DataFrame) -> DataFrame:
    return clickstream.select(
        "event_id",
        "user_id",
        "event_type",
        "product_id",
        F.col("timestamp").alias("event_timestamp"),
        "device",
        "session_id",
    )


STAGING = {
    "stg_users": ("users", stg_users),
    "stg_products": ("products", stg_products),
    "stg_orders": ("orders", stg_orders),
    "stg_order_items": ("order_items", stg_order_items),
    "stg_payments": ("payments", stg_payments),
    "stg_clickstream": ("clickstream", stg_clickstream),
}
