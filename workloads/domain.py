"""The given tables seen as the shop's current-state tables (rules in FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How the given codes map onto the shop's.
STATUS_OF_PRIORITY = {"1": "delivered", "2": "shipped", "3": "paid", "4": "pending", "5": "cancelled"}
METHODS = ("bank_transfer", "credit_card", "e_wallet", "cod")
EVENT_TYPE = {
    "view": "page_view",
    "click": "product_click",
    "signup": "search",
    "error": "add_to_cart",
    "purchase": "checkout",
}
DEVICES = ("mobile", "desktop", "tablet")
# An order line is identified by its order and product.
ITEM_ID_BASE = 10_000_000


def _given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lookup(mapping: dict[str, str], key):
    return F.element_at(F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]), key)


def _pick(values: tuple[str, ...], index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _given(spark, sf_dir, "customer")
    nation = _given(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    start = F.lit("2018-01-01 00:00:00").cast("timestamp")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        "city",
        (start + F.make_dt_interval((F.col("c_custkey") % 365).cast("int"))).alias("registered_at"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
        F.col("p_size").alias("stock"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantities = (
        _given(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"))
        .agg(F.sum("l_quantity").cast("int").alias("quantity"))
    )
    prices = products(spark, sf_dir).select(F.col("id").alias("product_id"), "price")
    return quantities.join(prices, "product_id").select(
        (F.col("order_id") * ITEM_ID_BASE + F.col("product_id")).alias("id"),
        "order_id",
        "product_id",
        "quantity",
        "price",
    )


def orders(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """The orders; ``lines`` are the order lines, if they are stored already."""
    given = _given(spark, sf_dir, "orders")
    totals = (
        (order_items(spark, sf_dir) if lines is None else lines)
        .groupBy("order_id")
        .agg(F.sum(F.col("quantity") * F.col("price")).alias("lines"))
    )
    # Every hundredth order's total is off by one, for the reconciliation check to find.
    off = F.when(F.col("id") % 100 == 0, F.lit("1.00")).otherwise(F.lit("0.00")).cast("decimal(3,2)")
    return (
        given.select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("user_id"),
            (F.col("o_orderdate") + F.expr("INTERVAL 24 YEARS")).cast("timestamp").alias("order_date"),
            _lookup(STATUS_OF_PRIORITY, F.substring("o_orderpriority", 1, 1)).alias("status"),
        )
        .join(totals.withColumnRenamed("order_id", "id"), "id", "left")
        .select(
            "id",
            "user_id",
            "order_date",
            "status",
            (F.coalesce("lines", F.lit(0)) + off).cast("decimal(14,2)").alias("total_amount"),
        )
    )


def payments_of(orders_df: DataFrame) -> DataFrame:
    success = F.col("status") != "cancelled"
    paid_at = F.col("order_date") + F.make_dt_interval(mins=(F.col("id") % 60 + 1).cast("int"))
    return orders_df.filter(F.col("status") != "pending").select(
        "id",
        F.col("id").alias("order_id"),
        _pick(METHODS, F.col("id") % 4).alias("payment_method"),
        F.col("total_amount").alias("amount"),
        F.when(success, "success").otherwise("failed").alias("status"),
        F.when(success, paid_at).alias("paid_at"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments_of(orders(spark, sf_dir))


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver clickstream: each event once, with the position of its first delivery."""
    return _given(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        "user_id",
        _lookup(EVENT_TYPE, F.col("event_type")).alias("event_type"),
        (F.col("event_id") % 200).alias("product_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        _pick(DEVICES, F.col("event_id") % 3).alias("device"),
        F.concat(F.lit("s"), F.col("event_id").cast("string")).alias("session_id"),
        (F.col("user_id") % 3).cast("int").alias("_bronze_partition"),
        F.col("event_id").alias("_bronze_offset"),
    )


SILVER = {
    "users": users,
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "payments": payments,
    "clickstream": clickstream,
}


def silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in SILVER.items()}
