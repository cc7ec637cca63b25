"""Declared schemas of topics, current-state tables and events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The columns of a topic message and of the raw archive.
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

# The raw tables are laid out by the day a message came in.
INGEST_DATE = "ingest_date"
BRONZE_TABLE_SCHEMA = T.StructType([*BRONZE_SCHEMA.fields, T.StructField(INGEST_DATE, T.DateType())])

# Lineage columns of the current-state tables: where the stored image came from.
LINEAGE = ("_bronze_partition", "_bronze_offset")
# Kept with the stored rows and not shown to readers: the message time of the stored image, and whether the key is deleted.
CHANGED_AT, DELETED = "_bronze_timestamp", "_deleted"
MARKS = T.StructType([T.StructField(CHANGED_AT, T.TimestampType()), T.StructField(DELETED, T.BooleanType())])


@dataclass(frozen=True)
class Field:
    """One column and how its wire text becomes a typed value."""

    name: str
    kind: str  # long | int | string | decimal | micros | iso
    precision: int = 12
    scale: int = 2

    @property
    def data_type(self) -> T.DataType:
        match self.kind:
            case "long":
                return T.LongType()
            case "int":
                return T.IntegerType()
            case "decimal":
                return T.DecimalType(self.precision, self.scale)
            case "micros" | "iso":
                return T.TimestampType()
            case _:
                return T.StringType()


@dataclass(frozen=True)
class TableSpec:
    """A change-captured table: its topic, primary key and columns."""

    name: str
    topic: str
    fields: tuple[Field, ...]
    key: str = "id"

    @property
    def wire_schema(self) -> T.StructType:
        """Every column as text, so that one odd value never loses the rest of its row."""
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.fields])

    @property
    def silver_schema(self) -> T.StructType:
        typed = [T.StructField(f.name, f.data_type) for f in self.fields]
        lineage = [T.StructField(LINEAGE[0], T.IntegerType()), T.StructField(LINEAGE[1], T.LongType())]
        return T.StructType(typed + lineage)


# Tables, topics, columns and types of the shop.  Keys are 64-bit so that they outlast 2^31 rows.
USERS = TableSpec(
    "users",
    "ecommerce.public.users",
    (
        Field("id", "long"),
        Field("name", "string"),
        Field("email", "string"),
        Field("city", "string"),
        Field("registered_at", "micros"),
    ),
)
PRODUCTS = TableSpec(
    "products",
    "ecommerce.public.products",
    (
        Field("id", "long"),
        Field("name", "string"),
        Field("category", "string"),
        Field("price", "decimal", 12),
        Field("stock", "int"),
    ),
)
ORDERS = TableSpec(
    "orders",
    "ecommerce.public.orders",
    (
        Field("id", "long"),
        Field("user_id", "long"),
        Field("order_date", "micros"),
        Field("status", "string"),
        Field("total_amount", "decimal", 14),
    ),
)
ORDER_ITEMS = TableSpec(
    "order_items",
    "ecommerce.public.order_items",
    (
        Field("id", "long"),
        Field("order_id", "long"),
        Field("product_id", "long"),
        Field("quantity", "int"),
        Field("price", "decimal", 12),
    ),
)
PAYMENTS = TableSpec(
    "payments",
    "ecommerce.public.payments",
    (
        Field("id", "long"),
        Field("order_id", "long"),
        Field("payment_method", "string"),
        Field("amount", "decimal", 14),
        Field("status", "string"),
        Field("paid_at", "micros"),
    ),
)
CLICK_FIELDS = (
    Field("event_id", "string"),
    Field("user_id", "long"),
    Field("event_type", "string"),
    Field("product_id", "long"),
    Field("timestamp", "iso"),
    Field("device", "string"),
    Field("session_id", "string"),
)
CLICK_TOPIC = "clickstream-events"

CDC_TABLES = {spec.name: spec for spec in (USERS, PRODUCTS, ORDERS, ORDER_ITEMS, PAYMENTS)}
TOPICS = (CLICK_TOPIC, *(spec.topic for spec in CDC_TABLES.values()))

CLICK_SILVER_SCHEMA = T.StructType(
    [T.StructField(f.name, f.data_type) for f in CLICK_FIELDS]
    + [T.StructField(LINEAGE[0], T.IntegerType()), T.StructField(LINEAGE[1], T.LongType())]
)
