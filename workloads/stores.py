"""Topics, raw tables and current-state tables of the workload, written once per application and given tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import BRONZE_SCHEMA, CDC_TABLES, CLICK_TOPIC
from tidemark.session import use_work_folder, work_folder, work_path
from tidemark.sources.topics import read_topic
from tidemark.streaming.landing import to_bronze
from workloads import domain, logs

def ensure_work_folder(spark: SparkSession) -> None:
    """In local mode without a shared folder: one temporary folder per application."""
    if work_folder(spark) is None and spark.sparkContext.master.startswith("local"):
        use_work_folder(spark, tempfile.mkdtemp(prefix="tidemark-"))


_written: dict[tuple[str, ...], str] = {}


def _once(spark: SparkSession, sf_dir: str, kind: str, name: str, build) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, kind, name)
    if key not in _written:
        path = work_path(spark, f"{kind}-{name}")
        build().write.parquet(path)
        _written[key] = path
    return _written[key]


# Tables whose rows take joins or groupings to make: stored once, topics and other tables are made from what is stored.
_MADE = ("orders", "order_items", "payments")


def messages(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """The messages of one topic, over stored tables where making them takes more than a scan."""

    def rows(name: str) -> DataFrame:
        return silver(spark, sf_dir, name) if name in _MADE else domain.SILVER[name](spark, sf_dir)

    return logs.messages(spark, sf_dir, topic, rows)


def bronze(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """The raw table of one topic."""
    path = _once(spark, sf_dir, "bronze", topic, lambda: to_bronze(messages(spark, sf_dir, topic)))
    return spark.read.schema(BRONZE_SCHEMA).parquet(path)


def bronze_of(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return bronze(spark, sf_dir, CDC_TABLES[table].topic)


def topic_path(spark: SparkSession, sf_dir: str, topic: str) -> str:
    """Folder of Kafka-shaped message files of one topic."""
    return _once(spark, sf_dir, "topic", topic, lambda: messages(spark, sf_dir, topic))


def topic_frame(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """The messages of one topic as a table."""
    return spark.read.parquet(topic_path(spark, sf_dir, topic))


def topic_stream(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    return read_topic(spark, topic, fmt="parquet", path=topic_path(spark, sf_dir, topic))


def silver_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Where a current-state table is stored (payments are derived from the stored orders, orders from the lines if those are stored)."""
    if name == "payments":
        return _once(spark, sf_dir, "silver", name, lambda: domain.payments_of(silver(spark, sf_dir, "orders")))
    if name == "orders" and (spark.sparkContext.applicationId, sf_dir, "silver", "order_items") in _written:
        return _once(spark, sf_dir, "silver", name, lambda: domain.orders(spark, sf_dir, silver(spark, sf_dir, "order_items")))
    return _once(spark, sf_dir, "silver", name, lambda: domain.SILVER[name](spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A current-state table."""
    return spark.read.parquet(silver_path(spark, sf_dir, name))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze(spark, sf_dir, CLICK_TOPIC)


def lines_first(spark: SparkSession, sf_dir: str) -> None:
    """Store the order lines, for what needs both them and the orders: these are then made from what is stored."""
    silver_path(spark, sf_dir, "order_items")


def all_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    lines_first(spark, sf_dir)
    return {name: silver(spark, sf_dir, name) for name in domain.SILVER}
