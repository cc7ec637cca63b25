"""The star schema: dimensions and facts."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key, day_of_week
from tidemark.plans.models import Model, resolve
from tidemark.plans.staging import STAGING
from tidemark.sources.published import Published

# The days the date dimension covers by default.
FIRST_DAY = date(2024, 1, 1)
LAST_DAY = date(2026, 12, 31)


MARTS = ("dim_users", "dim_products", "dim_date", "fact_orders", "fact_clickstream")


def dim_users(users: DataFrame) -> DataFrame:
    return users.select("user_id", "name", "email", "city", "registered_at")


def dim_products(products: DataFrame) -> DataFrame:
    return products.select("product_id", "name", "category", "price", "stock")


def dim_date(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included."""
    spine = spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))).alias("full_date")
    )
    day = F.col("full_date")
    return spine.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        day_of_week(day).alias("day_of_week"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
    )


def fact_orders(order_items: DataFrame, orders: DataFrame, payments: DataFrame, by_order: bool = False) -> DataFrame:
    """One row per product of an order, with the order's payment if there is one.

    An order with several payments yields its lines once per payment.  Orders meet payments first: both are about one
    row per order, and the lines, the largest input, are shuffled once.  The left join is written as an inner join and the
    orders without a payment: Spark can then split an order with very many lines or payments on either side of each join.

    ``by_order``: the inputs are stored in buckets by order (``stored_by_order``). Then there is no shuffle to split, and a plain
    left join keeps it so.
    """
    paid = payments.select("order_id", "payment_method", F.col("status").alias("payment_status"), "paid_at")
    heads = orders.select("order_id", "user_id", "order_date", F.col("status").alias("order_status"))
    if by_order:
        headers = heads.join(paid, "order_id", "left")
    else:
        unpaid = heads.join(paid.select("order_id"), "order_id", "left_anti")
        headers = heads.join(paid, "order_id").unionByName(unpaid, allowMissingColumns=True)
    lines = order_items.join(headers, "order_id")
    return lines.select(
        "order_item_id",
        "order_id",
        "user_id",
        "product_id",
        date_key(F.col("order_date")).alias("date_key"),
        "order_status",
        "quantity",
        F.col("price").alias("unit_price"),
        (F.col("quantity") * F.col("price")).cast("decimal(18,2)").alias("line_total"),
        "payment_method",
        "payment_status",
        "paid_at",
        "order_date",
    )


def fact_clickstream(clickstream: DataFrame) -> DataFrame:
    """One row per event."""
    return clickstream.select(
        "event_id",
        "user_id",
        "product_id",
        date_key(F.col("event_timestamp")).alias("date_key"),
        "event_type",
        "device",
        "session_id",
        "event_timestamp",
    )


def star_models(first: date = FIRST_DAY, last: date = LAST_DAY) -> list[Model]:
    """Staging, dimensions and facts over the current-state tables."""
    staging = [Model(name, (source,), model) for name, (source, model) in STAGING.items()]
    return staging + [
        Model("dim_users", ("stg_users",), dim_users),
        Model("dim_products", ("stg_products",), dim_products),
        Model("dim_date", (), lambda: dim_date(SparkSession.active(), first, last)),
        Model("fact_orders", ("stg_order_items", "stg_orders", "stg_payments"), fact_orders),
        Model("fact_clickstream", ("stg_clickstream",), fact_clickstream),
    ]


def _given(tables: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    return {name: partial(tables.__getitem__, name) for name in tables}


def build_staging(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All staging projections of the current-state tables."""
    return resolve(_given(silver), star_models(), STAGING)


def build_marts(
    spark: SparkSession, staging: Mapping[str, DataFrame], first: date = FIRST_DAY, last: date = LAST_DAY
) -> dict[str, DataFrame]:
    """All dimensions and facts over the staging projections."""
    return resolve(_given(staging), [m for m in star_models(first, last) if m.name in MARTS], MARTS)


def published_marts(spark: SparkSession, folder: str, database: str | None = None, buckets: int = 64) -> Published:
    """The star schema below ``folder``, as tables and views of ``database`` (by default one of its own); lines are bucketed by order."""
    own = f"marts_{hashlib.sha256(folder.rstrip('/').encode()).hexdigest()[:12]}"
    return Published(spark, folder, database or own, {"fact_orders": "order_id"}, buckets)


def stored_by_order(spark: SparkSession, staging: Mapping[str, DataFrame], folder: str, database: str, buckets: int = 64) -> dict[str, DataFrame]:
    """Orders, lines and payments stored by order: what joins them from here on, ``fact_orders`` above all, shuffles nothing."""
    names = ("stg_orders", "stg_order_items", "stg_payments")
    return Published(spark, folder, database, dict.fromkeys(names, "order_id"), buckets).publish({n: staging[n] for n in names})


def write_marts(
    spark: SparkSession, marts: Mapping[str, DataFrame], folder: str, database: str | None = None, buckets: int = 64
) -> dict[str, DataFrame]:
    """Publish the marts, all at once, and return them as read back; staging stays a view."""
    return published_marts(spark, folder, database, buckets).publish(marts)
