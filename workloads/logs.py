"""Topic messages derived from the given tables (rules in FIXTURES.md, section 4)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import CDC_TABLES, CLICK_TOPIC, ORDERS, USERS, TableSpec
from workloads import domain

# Second deliveries of an event come this much later in its partition.
REDELIVERY = 1_000_000_000


def decimal_to_base64(value: Column, scale: int = 2) -> Column:
    """Base64 of the shortest big-endian two's-complement form of the unscaled value (up to 8 bytes)."""
    unscaled = (value * F.lit(10**scale)).cast("bigint")
    # A sign bit and the digits of the number, or of its complement if it is negative, in whole bytes.
    bits = F.length(F.bin(F.when(unscaled < 0, F.bitwise_not(unscaled)).otherwise(unscaled)))
    size = F.floor((bits + 8) / 8).cast("int")
    digits = F.lpad(F.hex(unscaled), 16, F.lit("0"))
    return F.base64(F.unhex(F.right(digits, size * 2)))


def row_image(df_columns: TableSpec, overrides: dict[str, Column] | None = None) -> Column:
    """The struct a change message carries for a row, in wire types."""
    parts = []
    for field in df_columns.fields:
        column = (overrides or {}).get(field.name, F.col(field.name))
        if field.kind == "decimal":
            column = decimal_to_base64(column, field.scale)
        elif field.kind == "micros":
            column = F.unix_micros(column)
        parts.append(column.alias(field.name))
    return F.struct(*parts)


def image_text(image: Column) -> Column:
    """A row image as it stands in a message."""
    return F.to_json(image, {"ignoreNullFields": "false"})


def envelope(before: Column | None, after: Column, op: Column) -> Column:
    """A change message around the texts of its images; an image that is not there is null."""
    texts = [F.lit("null") if text is None else F.coalesce(text, F.lit("null")) for text in (before, after)]
    head, between, behind = '{"schema":{"type":"struct","optional":false},"payload":{"before":', ',"after":', ',"op":"'
    return F.concat(F.lit(head), texts[0], F.lit(between), texts[1], F.lit(behind), op, F.lit('"}}'))


def _message(df: DataFrame, topic: str) -> DataFrame:
    """Columns ``row_id, value, partition, offset, timestamp`` -> topic messages."""
    key = F.to_json(F.struct(F.col("row_id").alias("id")))
    return df.select(
        key.cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        "timestamp",
    )


def orders_log(orders: DataFrame) -> DataFrame:
    """Every order's way through its statuses; some orders end deleted, with a tombstone after."""
    path = (
        F.when(F.col("status") == "delivered", F.array(*map(F.lit, ("pending", "paid", "shipped", "delivered"))))
        .when(F.col("status") == "shipped", F.array(*map(F.lit, ("pending", "paid", "shipped"))))
        .when(F.col("status") == "paid", F.array(*map(F.lit, ("pending", "paid"))))
        .when(F.col("status") == "pending", F.array(F.lit("pending")))
        .when(F.col("id") % 2 == 0, F.array(*map(F.lit, ("pending", "paid", "cancelled"))))
        .otherwise(F.array(*map(F.lit, ("pending", "cancelled"))))
    )
    # Images are written once per order and status, before the order is unfolded into its messages; the generator keeps Spark
    # from putting what they are made of into the lambda.
    whole = F.struct(row_image(ORDERS).alias("image"), path.alias("statuses"))
    images = F.transform("statuses", lambda status: image_text(F.col("image").withField("status", status)))
    rows = orders.select("id", "order_date", F.inline(F.array(whole))).select("id", "order_date", images.alias("path"))
    last = F.size("path") - 1

    def step(number: Column, before: Column, after: Column, op: Column) -> Column:
        return F.struct(
            number.cast("int").alias("step"), before.alias("before"), after.alias("after"), op.alias("op")
        )

    none = F.lit(None).cast("string")
    moves = F.transform(
        "path",
        lambda image, i: step(
            i, F.when(i > 0, F.get("path", i - 1)), image, F.when(i == 0, F.lit("c")).otherwise(F.lit("u"))
        ),
    )
    ending = F.array(
        step(F.lit(5), F.get("path", last), none, F.lit("d")), step(F.lit(6), none, none, none)
    )
    steps = F.when(F.col("id") % 50 == 7, F.concat(moves, ending)).otherwise(moves)
    events = rows.withColumn("last", last).select("*", F.inline(steps)).drop("path")
    speed = (1 + F.col("id") % 7).cast("int")
    moved = F.least("step", "last")
    hours = F.when(F.col("step") > F.col("last"), 1).otherwise(0)
    at = F.col("order_date") + F.make_dt_interval(days=moved * moved * speed, hours=hours)

    value = F.when(F.col("op").isNotNull(), envelope(F.col("before"), F.col("after"), F.col("op")))
    return _message(
        events.select(
            F.col("id").alias("row_id"),
            value.alias("value"),
            (F.col("id") % 3).alias("partition"),
            (F.col("id") * 8 + F.col("step")).alias("offset"),
            at.alias("timestamp"),
        ),
        ORDERS.topic,
    )


def table_log(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """A snapshot read of a table; some users change their address afterwards."""
    if spec is ORDERS:
        return orders_log(rows)
    taken = F.lit("2025-09-01 00:00:00").cast("timestamp")
    image = image_text(row_image(spec))
    reads = [F.struct(F.lit(0).alias("step"), envelope(None, image, F.lit("r")).alias("value"))]
    messages = F.array(*reads)
    if spec is USERS:
        email = F.concat(F.lit("c"), F.col("id").cast("string"), F.lit("@new.example.com"))
        changed = image_text(row_image(spec, {"email": email}))
        update = F.struct(F.lit(1).alias("step"), envelope(image, changed, F.lit("u")).alias("value"))
        messages = F.when(F.col("id") % 10 == 3, F.array(*reads, update)).otherwise(messages)
    return _message(
        rows.select("id", F.inline(messages)).select(
            F.col("id").alias("row_id"),
            "value",
            (F.col("id") % 3).alias("partition"),
            (F.col("id") * 2 + F.col("step")).alias("offset"),
            (taken + F.make_dt_interval(hours=F.col("step"))).alias("timestamp"),
        ),
        spec.topic,
    )


def clicks_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as JSON; each twentieth is delivered twice."""
    events = domain.clickstream(spark, sf_dir)
    value = F.to_json(
        F.struct(
            "event_id",
            "user_id",
            "event_type",
            "product_id",
            F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp"),
            "device",
            "session_id",
        )
    )
    number = F.col("_bronze_offset")
    deliveries = F.when(number % 20 == 0, F.array(number, number + REDELIVERY)).otherwise(F.array(number))
    return events.select("*", F.explode(deliveries).alias("offset")).select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(CLICK_TOPIC).alias("topic"),
        F.col("_bronze_partition").alias("partition"),
        "offset",
        "timestamp",
    )


def messages(spark: SparkSession, sf_dir: str, topic: str, rows: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """All messages of one topic; ``rows`` gives the shop's tables where they are stored already."""
    if topic == CLICK_TOPIC:
        return clicks_log(spark, sf_dir)
    spec = next(s for s in CDC_TABLES.values() if s.topic == topic)
    return table_log(rows(spec.name) if rows else domain.SILVER[spec.name](spark, sf_dir), spec)
