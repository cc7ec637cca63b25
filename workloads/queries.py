"""The registered queries."""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.errors import SparkRuntimeException as SparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import operators as op
from tidemark import plans
from tidemark.functions import decimal_from_base64, iso_timestamp, micro_timestamp
from tidemark.operators.changes import decode_failures
from tidemark.operators.checks import CHECKS
from tidemark.plans import questions as q
from tidemark.plans.marts import build_marts, build_staging, published_marts, star_models, stored_by_order, write_marts
from tidemark.plans.models import Model, resolve
from tidemark.plans.run import refresh_silver, run_lakehouse, silver_table
from tidemark.schemas import BRONZE_SCHEMA, CDC_TABLES, CLICK_SILVER_SCHEMA, CLICK_TOPIC, ORDERS, TOPICS
from tidemark.session import configure, work_path
from tidemark.sources import SourceBinding, bronze_table, export_tables, exported, read_bronze, read_table, read_topic, stream_bronze
from tidemark.sources.progress import Marks, Progress
from tidemark.streaming import (
    History,
    apply_cdc_stream,
    deliveries,
    first_deliveries,
    keep_state,
    land_topic,
    land_topics,
    read_state,
    refine_clickstream_stream,
    refresh_table,
    stage_counts,
    visit_sessions,
    write_stream,
)
from tidemark.streaming.apply import apply_batch
from workloads import domain, logs, stores

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
BUCKETS = 16
# The second arrival of events starts on this day.
SECOND_ARRIVAL = "2024-01-16"


def portable(df: DataFrame) -> DataFrame:
    """Column types that read the same from any engine."""
    out = []
    for field in df.schema.fields:
        column = F.col(field.name)
        match field.dataType:
            case T.DecimalType():
                column = column.cast("string")  # every digit counts
            case T.DateType():
                column = column.cast("string")
            case T.TimestampType():
                column = column.cast("timestamp_ntz")
        out.append(column.alias(field.name))
    return df.select(*out)


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(build(configure(spark), sf_dir))

    REGISTRY[build.__name__] = run
    return build


def _silver_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.fact_orders(
        plans.stg_order_items(stores.silver(spark, sf_dir, "order_items")),
        plans.stg_orders(stores.silver(spark, sf_dir, "orders")),
        plans.stg_payments(stores.silver(spark, sf_dir, "payments")),
    )


def _dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.dim_products(plans.stg_products(stores.silver(spark, sf_dir, "products")))


def _fact_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.fact_clickstream(plans.stg_clickstream(stores.silver(spark, sf_dir, "clickstream")))


# -- landing -------------------------------------------------------------------------------------------------------


def _landed(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    out = work_path(spark, "landed")
    land_topic(stores.topic_stream(spark, sf_dir, topic), out, f"{out}-checkpoint").awaitTermination()
    return read_table(spark, out, schema=BRONZE_SCHEMA)


@query
def bronze_land_clickstream(spark, sf_dir):
    texts = "event_id string, user_id bigint, event_type string, product_id bigint, timestamp string, device string, session_id string"
    landed = _landed(spark, sf_dir, CLICK_TOPIC)
    event = landed.select("topic", "partition", "offset", "timestamp", F.from_json("value", texts).alias("event"))
    return event.withColumns(
        {"event_timestamp": iso_timestamp(F.col("event.timestamp")), "event": F.col("event").dropFields("timestamp")}
    ).select("topic", "partition", "offset", "timestamp", "event_timestamp", "event.*")


@query
def bronze_land_orders(spark, sf_dir):
    return _landed(spark, sf_dir, ORDERS.topic).select(
        "key",
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.get_json_object("value", "$.payload.op").alias("op"),
        F.col("value").isNull().alias("tombstone"),
    )


@query
def bronze_land_topics(spark, sf_dir):
    stores.lines_first(spark, sf_dir)
    paths = land_topics({t: stores.topic_stream(spark, sf_dir, t) for t in TOPICS}, work_path(spark, "bronze"))
    landed = reduce(DataFrame.unionByName, [read_table(spark, p, schema=BRONZE_SCHEMA) for p in paths.values()])
    return landed.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


@query
def bronze_resume(spark, sf_dir):
    """Two arrivals and an idle run on one checkpoint: rows that each of the three runs added."""
    inbox, out = work_path(spark, "inbox"), work_path(spark, "landed")
    arrivals = stores.messages(spark, sf_dir, ORDERS.topic)
    parts = [arrivals.filter("offset % 2 = 0"), arrivals.filter("offset % 2 = 1"), None]
    seen = []
    for number, part in enumerate(parts, start=1):
        if part is not None:
            part.write.mode("append").parquet(inbox)
        stream = read_topic(spark, ORDERS.topic, fmt="parquet", path=inbox)
        land_topic(stream, out, f"{out}-checkpoint").awaitTermination()
        landed = read_table(spark, out, schema=BRONZE_SCHEMA)
        seen.append(landed.groupBy("partition").agg(F.count(F.lit(1)).alias(f"after_run_{number}")))
    total = seen[0].join(seen[1], "partition").join(seen[2], "partition")
    return total.select(
        "partition",
        F.col("after_run_1").alias("run_1"),
        (F.col("after_run_2") - F.col("after_run_1")).alias("run_2"),
        (F.col("after_run_3") - F.col("after_run_2")).alias("run_3"),
    )


@query
def bronze_rate_limited(spark, sf_dir):
    """A backlog of six files or more, at most a third of them to a micro-batch: the same rows, in more than one batch."""
    root = work_path(spark, "backlog")
    messages = stores.topic_frame(spark, sf_dir, ORDERS.topic)
    # A file is one task's to write, so their number follows the backlog: a few for each file of the topic.
    files = 6 * len(messages.inputFiles())
    messages.repartition(files).write.parquet(f"{root}/inbox")
    stream = read_topic(spark, ORDERS.topic, fmt="parquet", path=f"{root}/inbox", limit=files // 3)
    run = land_topic(stream, f"{root}/raw", f"{root}/checkpoint")
    run.awaitTermination()
    batches = len([p for p in run.recentProgress if p["numInputRows"]])
    landed = read_bronze(spark, f"{root}/raw")
    counts = landed.groupBy("partition").agg(F.count(F.lit(1)).alias("messages"), F.max("offset").alias("last_offset"))
    return counts.withColumn("several_batches", F.lit(batches > 1))


@query
def bronze_pruned_refresh(spark, sf_dir):
    """Two days of landing, a refresh after each: what it did, and the days whose messages it read."""
    root = work_path(spark, "days")
    messages = stores.topic_frame(spark, sf_dir, ORDERS.topic)
    middle = messages.agg(F.max("offset")).first()[0] // 2
    target, progress = silver_table(spark, f"{root}/silver", ORDERS, BUCKETS), Progress(spark, f"{root}/progress")
    lines = []
    for day, part in (("2025-01-01", messages.filter(F.col("offset") <= middle)), ("2025-01-02", messages.filter(F.col("offset") > middle))):
        part.write.mode("append").parquet(f"{root}/inbox")
        stream = read_topic(spark, ORDERS.topic, fmt="parquet", path=f"{root}/inbox")
        land_topic(stream, f"{root}/raw", f"{root}/checkpoint", ingested_at=F.lit(day).cast("timestamp")).awaitTermination()
        raw = bronze_table(spark, f"{root}/raw")
        fresh = (progress.read() or Marks()).rows_after(raw)
        days = fresh.agg(F.concat_ws(",", F.sort_array(F.collect_set(F.col("ingest_date").cast("string"))))).first()[0]
        result = refresh_table(raw, ORDERS, target, progress)
        lines.append((days, fresh.count(), *result.values()))
    return spark.createDataFrame(lines, "days_read string, messages long, inserted long, updated long, deleted long")


# -- decoding ------------------------------------------------------------------------------------------------------


@query
def decode_decimal(spark, sf_dir):
    amount = F.col("total_amount")
    wire = stores.silver(spark, sf_dir, "orders").select(
        "id", logs.decimal_to_base64(amount).alias("amount"), logs.decimal_to_base64(-amount).alias("refund")
    )
    return wire.select(
        "id", *[decimal_from_base64(F.col(c), 14, 2).alias(c) for c in ("amount", "refund")]
    )


@query
def decode_timestamp(spark, sf_dir):
    wire = stores.silver(spark, sf_dir, "payments").select("id", F.unix_micros("paid_at").cast("string").alias("paid_at"))
    return wire.select("id", micro_timestamp(F.col("paid_at")).alias("paid_at"))


@query
def decode_iso(spark, sf_dir):
    """Event times written with ``+00:00``, with ``Z`` and with a seven-hour offset."""
    at = F.col("timestamp")
    form = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    number = F.col("_bronze_offset")
    wire = stores.silver(spark, sf_dir, "clickstream").select(
        "event_id",
        F.when(number % 3 == 0, F.date_format(at, form + "xxx"))
        .when(number % 3 == 1, F.concat(F.date_format(at, form), F.lit("Z")))
        .otherwise(F.concat(F.date_format(at + F.make_dt_interval(hours=F.lit(7)), form), F.lit("+07:00")))
        .alias("text"),
    )
    return wire.select("event_id", iso_timestamp(F.col("text")).alias("at"))


@query
def dq_decode_failures(spark, sf_dir):
    """Every fortieth message of each change topic carries amounts and dates that do not decode."""
    stores.lines_first(spark, sf_dir)
    found = []
    for spec in CDC_TABLES.values():
        bronze, broken = stores.bronze_of(spark, sf_dir, spec.name), F.col("value")
        for field in spec.fields:
            if field.kind == "decimal":
                broken = F.regexp_replace(broken, f'"{field.name}":"[^"]*"', f'"{field.name}":"####"')
            elif field.kind == "micros":
                broken = F.regexp_replace(broken, f'"{field.name}":[0-9]+', f'"{field.name}":"soon"')
        damaged = bronze.withColumn("value", F.when(F.col("offset") % 40 == 0, broken).otherwise(F.col("value")))
        found.append(decode_failures(damaged, spec))
    return reduce(DataFrame.unionByName, found)


@query
def dq_rejects(spark, sf_dir):
    """Messages of all change topics that are not applied, by reason; some of the orders' are damaged by rule."""
    stores.lines_first(spark, sf_dir)
    found = None
    for spec in CDC_TABLES.values():
        bronze = stores.bronze_of(spark, sf_dir, spec.name)
        if spec is ORDERS:
            step = F.col("offset") % 40
            value = F.when(F.col("value").isNull(), None).when(step == 8, "{broken").when(step == 16, '{"schema":{}}')
            no_id = F.regexp_replace("value", '"id":[0-9]+', '"id":"?"')
            bronze = bronze.withColumn("value", value.when(step == 24, no_id).otherwise(F.col("value")))
        counts = op.reject_counts(bronze, spec)
        found = counts if found is None else found.unionByName(counts)
    return found


# -- change capture ------------------------------------------------------------------------------------------------


@query
def cdc_envelope(spark, sf_dir):
    return op.parse_envelope(stores.bronze_of(spark, sf_dir, "orders"), ORDERS).select(
        "row_key",
        "op",
        F.col("before.status").alias("before_status"),
        F.col("after.status").alias("after_status"),
        "partition",
        "offset",
        "timestamp",
    )


def _latest(spark, sf_dir):
    return op.latest_changes(stores.bronze_of(spark, sf_dir, "orders"), ORDERS)


@query
def cdc_latest(spark, sf_dir):
    return _latest(spark, sf_dir).select("row_key", "op", "offset", F.col("after.status").alias("status"))


@query
def cdc_upsert_split(spark, sf_dir):
    return op.split_changes(_latest(spark, sf_dir), ORDERS)[0]


@query
def cdc_deletes(spark, sf_dir):
    return op.split_changes(_latest(spark, sf_dir), ORDERS)[1]


def _rounds(spark, sf_dir):
    """The order log in three arrivals that keep each order's own sequence."""
    bronze = stores.bronze_of(spark, sf_dir, "orders")
    step = F.col("offset") % 8
    return [bronze.filter(step < 2), bronze.filter((step >= 2) & (step < 4)), bronze.filter(step >= 4)]


@query
def cdc_merge(spark, sf_dir):
    target = silver_table(spark, work_path(spark, "silver"), ORDERS, BUCKETS)
    for part in _rounds(spark, sf_dir):
        apply_batch(part, ORDERS, target)
    return target.read()


@query
def cdc_merge_repartitioned(spark, sf_dir):
    """Orders whose messages move to another partition; the first arrival comes again."""
    target = silver_table(spark, work_path(spark, "silver"), ORDERS, BUCKETS)
    rounds = [_moved(part) for part in _rounds(spark, sf_dir)]
    for part in [*rounds, rounds[0]]:
        apply_batch(part, ORDERS, target)
    return target.read()


@query
def cdc_replay_after_delete(spark, sf_dir):
    """The first two arrivals come again after the third, which holds the deletes."""
    target = silver_table(spark, work_path(spark, "silver"), ORDERS, BUCKETS)
    rounds = _rounds(spark, sf_dir)
    for part in [*rounds, *rounds[:2]]:
        apply_batch(part, ORDERS, target)
    return target.read()


@query
def cdc_merge_metrics(spark, sf_dir):
    """What each of three arrivals did, as observed on the rows that were written."""
    target = silver_table(spark, work_path(spark, "silver"), ORDERS, BUCKETS)
    lines = [(n, *apply_batch(part, ORDERS, target).values()) for n, part in enumerate(_rounds(spark, sf_dir), start=1)]
    return spark.createDataFrame(lines, "arrival int, inserted long, updated long, deleted long")


@query
def cdc_checkpoint_reset(spark, sf_dir):
    """The streaming form with a new checkpoint for every arrival, each of which reads everything again."""
    root = work_path(spark, "reset")
    target = silver_table(spark, f"{root}/silver", ORDERS, BUCKETS)
    for number, part in enumerate(_rounds(spark, sf_dir)):
        part.write.mode("append").parquet(f"{root}/bronze")
        changes = spark.readStream.schema(BRONZE_SCHEMA).parquet(f"{root}/bronze")
        apply_cdc_stream(changes, ORDERS, target, f"{root}/checkpoint-{number}").awaitTermination()
    return target.read()


@query
def cdc_stream_state(spark, sf_dir):
    """The three arrivals through state that is kept per key; a batch writes the keys it changes."""
    root = work_path(spark, "state")
    for part in _rounds(spark, sf_dir):
        part.write.mode("append").parquet(f"{root}/bronze")
        changes = spark.readStream.schema(BRONZE_SCHEMA).parquet(f"{root}/bronze")
        keep_state(changes, ORDERS, f"{root}/log", f"{root}/checkpoint").awaitTermination()
    return read_state(spark, f"{root}/log", ORDERS)


def _moved(part: DataFrame) -> DataFrame:
    """From its third step on an order's messages are in another partition, at lower offsets."""
    moved = F.col("offset") % 8 >= 2
    return part.withColumns(
        {
            "partition": F.when(moved, F.lit(3)).otherwise(F.col("partition")),
            "offset": F.when(moved, F.col("offset") - 4).otherwise(F.col("offset")),
        }
    )


@query
def cdc_stream_apply(spark, sf_dir):
    """The same three arrivals through both streams: topic to raw table, raw table to current state."""
    root = work_path(spark, "stream")
    inbox, raw = f"{root}/inbox", f"{root}/bronze"
    target = silver_table(spark, f"{root}/silver", ORDERS, BUCKETS)
    messages = spark.read.parquet(stores.topic_path(spark, sf_dir, ORDERS.topic))
    for low, high in ((0, 2), (2, 4), (4, 8)):
        messages.filter((F.col("offset") % 8 >= low) & (F.col("offset") % 8 < high)).write.mode("append").parquet(inbox)
        stream = read_topic(spark, ORDERS.topic, fmt="parquet", path=inbox)
        land_topic(stream, raw, f"{root}/landing").awaitTermination()
        apply_cdc_stream(stream_bronze(spark, raw), ORDERS, target, f"{root}/applying").awaitTermination()
    return target.read()


@query
def cdc_history(spark, sf_dir):
    return op.change_history(stores.bronze_of(spark, sf_dir, "orders"), ORDERS)


@query
def cdc_history_repartitioned(spark, sf_dir):
    """The history of orders whose messages move to another partition."""
    return op.change_history(_moved(stores.bronze_of(spark, sf_dir, "orders")), ORDERS)


@query
def cdc_history_incremental(spark, sf_dir):
    """The same in runs: the third arrival comes before the second, whose changes fall among versions already closed, and the first again."""
    history = History(spark, work_path(spark, "history"), ORDERS, BUCKETS)
    first, second, third = (_moved(part) for part in _rounds(spark, sf_dir))
    for part in (first, third, second, first):
        history.extend(part)
    return history.read()


def _silver_query(name: str) -> None:
    def build(spark, sf_dir):
        spec = CDC_TABLES[name]
        target = silver_table(spark, work_path(spark, "silver"), spec, BUCKETS)
        refresh_table(stores.bronze_of(spark, sf_dir, name), spec, target)
        return target.read()

    build.__name__ = f"silver_{name}"
    query(build)


for _name in CDC_TABLES:
    _silver_query(_name)


# -- clickstream ---------------------------------------------------------------------------------------------------


@query
def silver_clickstream(spark, sf_dir):
    return op.refine_clickstream(stores.clicks(spark, sf_dir))


@query
def clickstream_high_water(spark, sf_dir):
    raw = stores.clicks(spark, sf_dir).select(
        F.col("partition").alias("_bronze_partition"), F.col("offset").alias("_bronze_offset")
    )
    return op.high_water(raw)


def _first_arrival():
    return (F.col("timestamp") < F.lit(SECOND_ARRIVAL).cast("timestamp")) & (F.col("offset") < logs.REDELIVERY)


@query
def clickstream_incremental(spark, sf_dir):
    """A first run over half the events, then one over the whole raw table: which run stored which event."""
    raw = stores.clicks(spark, sf_dir)
    path = work_path(spark, "clicks")
    op.refine_clickstream(raw.filter(_first_arrival())).write.parquet(path)
    stored = read_table(spark, path, schema=CLICK_SILVER_SCHEMA)
    added = op.refine_clickstream(raw, stored)
    runs = [stored.withColumn("run", F.lit(1)), added.withColumn("run", F.lit(2))]
    return reduce(DataFrame.unionByName, runs).select("event_id", "user_id", "event_type", "_bronze_offset", "run")


@query
def clickstream_stream_dedup(spark, sf_dir):
    """Two arrivals through the streaming form; the second brings copies of events stored by the first."""
    root = work_path(spark, "stream")
    raw = stores.clicks(spark, sf_dir)
    for part in (raw.filter(_first_arrival()), raw.filter(~_first_arrival())):
        part.write.mode("append").parquet(f"{root}/bronze")
        stream = spark.readStream.schema(BRONZE_SCHEMA).parquet(f"{root}/bronze")
        refine_clickstream_stream(spark, stream, f"{root}/silver", f"{root}/checkpoint").awaitTermination()
    return read_table(spark, f"{root}/silver", schema=CLICK_SILVER_SCHEMA)


@query
def clickstream_without_id(spark, sf_dir):
    """Every tenth event lost its id; three checkpoints over one raw table store the same rows."""
    root = work_path(spark, "unnamed")
    no_id = F.regexp_replace("value", '"event_id":"[^"]*"', '"event_id":null')
    raw = stores.clicks(spark, sf_dir).filter(F.col("offset") < logs.REDELIVERY)
    raw.withColumn("value", F.when(F.col("offset") % 10 == 3, no_id).otherwise(F.col("value"))).write.parquet(f"{root}/bronze")
    for run in range(3):
        stream = spark.readStream.schema(BRONZE_SCHEMA).parquet(f"{root}/bronze")
        refine_clickstream_stream(spark, stream, f"{root}/silver", f"{root}/checkpoint-{run}").awaitTermination()
    return read_table(spark, f"{root}/silver", schema=CLICK_SILVER_SCHEMA)


def _two_runs(spark, sf_dir, delay):
    """The two arrivals through state of ``delay``: where the events are, and what each run said of its messages."""
    root = work_path(spark, "state")
    raw, said = stores.clicks(spark, sf_dir), []
    for part in (raw.filter(_first_arrival()), raw.filter(~_first_arrival())):
        part.write.mode("append").parquet(f"{root}/bronze")
        stream = spark.readStream.schema(BRONZE_SCHEMA).parquet(f"{root}/bronze")
        run = write_stream(first_deliveries(stream, delay), f"{root}/silver", f"{root}/checkpoint")
        run.awaitTermination()
        said.append(deliveries(run))
    return f"{root}/silver", said


@query
def clickstream_watermark_dedup(spark, sf_dir):
    """First deliveries of the two arrivals, by state of five days and without a look at what is stored."""
    path, _ = _two_runs(spark, sf_dir, "5 days")
    # Of two deliveries in one micro-batch either may be the one that is kept.
    return read_table(spark, path, schema=CLICK_SILVER_SCHEMA).drop("_bronze_offset")


@query
def clickstream_watermark_counts(spark, sf_dir):
    """Messages read, copies recognised and messages left out for being late, by run."""
    _, said = _two_runs(spark, sf_dir, "5 days")
    return spark.createDataFrame([(n, *s.values()) for n, s in enumerate(said, 1)], "run int, messages long, copies long, late long")


@query
def clickstream_counts(spark, sf_dir):
    """What three refreshes of all tables say of events and orders: half of the raw rows, all of them, nothing new."""
    root = work_path(spark, "counts")
    clicks, orders = stores.clicks(spark, sf_dir), stores.bronze_of(spark, sf_dir, "orders")
    middle = orders.agg(F.max("offset")).first()[0] // 2
    empty = orders.filter(F.lit(False))
    lines = []
    for number, (seen, upto) in enumerate([(_first_arrival(), F.col("offset") <= middle), (~_first_arrival(), F.col("offset") > middle), (None, None)], 1):
        if seen is not None:
            for topic, part in ((CLICK_TOPIC, clicks.filter(seen)), (ORDERS.topic, orders.filter(upto))):
                part.write.mode("append").parquet(f"{root}/bronze/{topic}")
        raw = {t: spark.read.schema(BRONZE_SCHEMA).parquet(f"{root}/bronze/{t}") if t in (CLICK_TOPIC, ORDERS.topic) else empty for t in TOPICS}
        result = refresh_silver(spark, raw, f"{root}/silver", BUCKETS)
        lines += [(number, name, *(result[name].get(c, 0) for c in ("inserted", "updated", "deleted", "tombstone"))) for name in ("clickstream", "orders")]
    return spark.createDataFrame(lines, "run int, table_name string, inserted long, updated long, deleted long, tombstones long")


# -- staging and star schema ---------------------------------------------------------------------------------------


def _staging_query(name: str, source: str, model) -> None:
    def build(spark, sf_dir):
        return model(stores.silver(spark, sf_dir, source))

    build.__name__ = name
    query(build)


for _name, (_source, _model) in plans.staging.STAGING.items():
    _staging_query(_name, _source, _model)


@query
def dim_users(spark, sf_dir):
    return plans.dim_users(plans.stg_users(stores.silver(spark, sf_dir, "users")))


@query
def dim_products(spark, sf_dir):
    return _dim_products(spark, sf_dir)


@query
def dim_date(spark, sf_dir):
    """The days from the first order to the last, with the orders of each day beside the calendar columns."""
    orders = stores.silver(spark, sf_dir, "orders").select(F.to_date("order_date").alias("full_date"))
    first, last = orders.agg(F.min("full_date"), F.max("full_date")).first()
    per_day = orders.groupBy("full_date").agg(F.count(F.lit(1)).alias("orders"))
    days = plans.dim_date(spark, first, last)
    return days.join(per_day, "full_date", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query
def fact_orders(spark, sf_dir):
    return _silver_facts(spark, sf_dir)


@query
def fact_clickstream(spark, sf_dir):
    return _fact_clicks(spark, sf_dir)


@query
def fact_orders_by_order(spark, sf_dir):
    """Orders, lines and payments stored in buckets by order, and joined without a shuffle."""
    root = work_path(spark, "by-order")
    staging = build_staging({n: stores.silver(spark, sf_dir, n) for n in domain.SILVER})
    stored = stored_by_order(spark, staging, root, f"d{root[-12:]}", BUCKETS)
    return plans.fact_orders(stored["stg_order_items"], stored["stg_orders"], stored["stg_payments"], by_order=True)


@query
def gold_published(spark, sf_dir):
    """Three publications of the star schema: of half the orders, one that fails on its way, and of all. What readers see after each."""
    silver = stores.all_silver(spark, sf_dir)
    gold = published_marts(spark, work_path(spark, "gold"), buckets=BUCKETS)
    late = F.col("id") == F.lit(silver["orders"].agg(F.max("id")).first()[0])
    broken = F.when(late, F.raise_error(F.lit("a write fails"))).otherwise(F.col("status"))
    half, failing = silver["orders"].filter("id % 2 = 0"), silver["orders"].withColumn("status", broken)
    lines = []
    for step, orders in enumerate((half, failing, silver["orders"]), start=1):
        marts = build_marts(spark, build_staging({**silver, "orders": orders}))
        try:
            gold.publish(marts)
        except SparkException:
            if step != 2:
                raise
        shown = spark.table(f"{gold.database}.fact_orders")
        seen = shown.agg(F.count(F.lit(1)), F.sum("line_total"), F.countDistinct("order_id")).first()
        lines.append((step, gold.version(), *seen))
    return spark.createDataFrame(lines, "step int, version int, lines long, amount decimal(28,2), orders long")


# A mart in SQL, and what it reads, declared after it: the order follows from the names.
MONTHLY = [
    Model.sql(
        "revenue_by_month",
        "SELECT period, category, sum(amount) AS revenue FROM {amounts} LEFT JOIN {dim_products} USING (product_id) GROUP BY ALL",
    ),
    Model.sql(
        "amounts",
        "SELECT to_date(date_trunc('month', order_date)) AS period, product_id, sum(line_total) AS amount "
        "FROM {fact_orders} WHERE payment_status = 'success' GROUP BY ALL",
    ),
]


@query
def gold_models_sql(spark, sf_dir):
    """Monthly revenue as models over named sources: stored tables bound to names, the star schema, and two SELECTs."""
    folder = os.path.dirname(stores.silver_path(spark, sf_dir, "orders"))
    places = {name: stores.silver_path(spark, sf_dir, name) for name in domain.SILVER}
    bound = SourceBinding(f"{folder}/{{name}}", tuple(places), opener=lambda session, name, _: read_table(session, places[name]))
    return resolve(bound.openers(spark), [*MONTHLY, *star_models()], ["revenue_by_month"])["revenue_by_month"]


# -- data tests ----------------------------------------------------------------------------------------------------


def damaged_silver(spark, sf_dir):
    """Current-state tables with one kind of damage for every kind of check."""
    t = stores.all_silver(spark, sf_dir)
    copies = t["users"].filter("id % 100 = 1")
    orders = t["orders"]
    return {
        "users": t["users"].unionByName(copies).unionByName(copies.filter("id % 200 = 1")),
        "products": t["products"],
        "orders": orders.withColumn("user_id", F.when(F.col("id") % 50 != 3, F.col("user_id"))).withColumn(
            "status",
            F.when(F.col("id") % 300 == 0, "returned").when(F.col("id") % 310 == 0, "lost").otherwise(F.col("status")),
        ),
        "order_items": t["order_items"].withColumn(
            "product_id", F.when(F.col("order_id") % 500 == 0, -F.col("product_id") - 1).otherwise(F.col("product_id"))
        ),
        "payments": t["payments"]
        .withColumn("status", F.when(F.col("id") % 400 == 1, "pending").otherwise(F.col("status")))
        .withColumn("order_id", F.when(F.col("id") % 900 == 2, -F.col("order_id")).otherwise(F.col("order_id"))),
        "clickstream": t["clickstream"].withColumn(
            "event_id", F.when(F.col("_bronze_offset") % 1000 != 5, F.col("event_id"))
        ),
    }


@query
def dq_unique(spark, sf_dir):
    return op.unique(damaged_silver(spark, sf_dir)["users"], "id")


@query
def dq_not_null(spark, sf_dir):
    return op.not_null(damaged_silver(spark, sf_dir)["orders"], "user_id").select("id", "status")


@query
def dq_relationships(spark, sf_dir):
    t = damaged_silver(spark, sf_dir)
    return op.relationships(t["order_items"], "product_id", t["products"], "id")


@query
def dq_accepted_values(spark, sf_dir):
    from tidemark.operators.checks import ORDER_STATUSES

    return op.accepted_values(damaged_silver(spark, sf_dir)["orders"], "status", ORDER_STATUSES)


@query
def dq_suite(spark, sf_dir):
    """All 38 checks over damaged tables, with the default date dimension."""
    staging = build_staging(damaged_silver(spark, sf_dir))
    marts = write_marts(spark, build_marts(spark, staging), work_path(spark, "marts"))
    return op.run_suite({**staging, **marts}, CHECKS)


@query
def reconcile_order_totals(spark, sf_dir):
    return q.order_total_gaps(stores.silver(spark, sf_dir, "orders"), stores.silver(spark, sf_dir, "order_items"))


@query
def reconcile_payment_presence(spark, sf_dir):
    """Every seventieth payment is missing, every thirtieth pending order has one."""
    orders = stores.silver(spark, sf_dir, "orders")
    paid = stores.silver(spark, sf_dir, "payments").filter("id % 70 <> 0").select("order_id")
    early = orders.filter("status = 'pending' AND id % 30 = 0").select(F.col("id").alias("order_id"))
    return q.payment_presence_gaps(orders, paid.unionByName(early))


# -- business questions --------------------------------------------------------------------------------------------


def _revenue_query(grain: str) -> None:
    def build(spark, sf_dir):
        return q.revenue(_silver_facts(spark, sf_dir), _dim_products(spark, sf_dir), grain)

    build.__name__ = f"bq1_revenue_{grain}"
    query(build)


for _grain in ("day", "week", "month"):
    _revenue_query(_grain)


@query
def bq2_top_products(spark, sf_dir):
    return q.top_products(_silver_facts(spark, sf_dir), _dim_products(spark, sf_dir))


@query
def bq2_trend(spark, sf_dir):
    trend = q.product_trend(_silver_facts(spark, sf_dir))
    # A double, since engines differ in how they hand over integers with gaps.
    return trend.withColumn("change", F.col("change").cast("double"))


@query
def bq3_funnel_users(spark, sf_dir):
    return q.funnel_users(_fact_clicks(spark, sf_dir), _silver_facts(spark, sf_dir))


@query
def bq3_funnel_ordered(spark, sf_dir):
    return q.funnel_ordered(_fact_clicks(spark, sf_dir), _silver_facts(spark, sf_dir))


def _click_stream(spark, sf_dir):
    """The stored event table as a stream."""
    path = stores.silver_path(spark, sf_dir, "clickstream")
    return spark.readStream.schema(CLICK_SILVER_SCHEMA).parquet(path)


def _streamed(spark, result: DataFrame) -> DataFrame:
    out = work_path(spark, "stream")
    write_stream(result, out, f"{out}-checkpoint").awaitTermination()
    return read_table(spark, out, schema=result.schema)


@query
def bq3_stream_counts(spark, sf_dir):
    return _streamed(spark, stage_counts(_click_stream(spark, sf_dir)))


@query
def bq4_time_to_convert(spark, sf_dir):
    return q.time_to_convert(_fact_clicks(spark, sf_dir))


@query
def bq4_sessions(spark, sf_dir):
    return q.sessions(_fact_clicks(spark, sf_dir))


@query
def bq4_stream_sessions(spark, sf_dir):
    return _streamed(spark, visit_sessions(_click_stream(spark, sf_dir)))


@query
def bq5_delivery_by_city(spark, sf_dir):
    return q.delivery_time(stores.bronze_of(spark, sf_dir, "orders"), stores.silver(spark, sf_dir, "users"))


@query
def bq6_cancel_rate(spark, sf_dir):
    return q.cancellation_rate(plans.stg_orders(stores.silver(spark, sf_dir, "orders")))


@query
def bq6_cancel_stage(spark, sf_dir):
    return q.cancellation_stages(stores.bronze_of(spark, sf_dir, "orders"))


@query
def bq7_payment_methods(spark, sf_dir):
    return q.payment_methods(plans.stg_payments(stores.silver(spark, sf_dir, "payments")))


# -- export and the whole run --------------------------------------------------------------------------------------


def _exported(spark, sf_dir):
    """Every current-state table exported twice, first without its even ids: the tables as read back, and the counts."""
    folder = work_path(spark, "export")
    tables = stores.all_silver(spark, sf_dir)
    export_tables({n: t.filter("id % 2 = 1") for n, t in tables.items() if "id" in t.columns}, folder)
    written = export_tables(tables, folder)
    return {name: spark.read.parquet(exported(spark, folder).path(name)) for name in written}, written


@query
def export_roundtrip(spark, sf_dir):
    """Every current-state table exported to Parquet and counted on the way back in."""
    back, written = _exported(spark, sf_dir)
    lines = [
        back[name].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows", F.lit(count).cast("bigint").alias("rows_written"))
        for name, count in written.items()
    ]
    return reduce(DataFrame.unionByName, lines)


@query
def export_content(spark, sf_dir):
    """Every row of every exported table, as text."""

    def text(field: T.StructField):
        column = F.unix_micros(field.name) if isinstance(field.dataType, T.TimestampType) else F.col(field.name)
        return F.coalesce(column.cast("string"), F.lit("-"))

    def rows(name: str, df: DataFrame):
        fields = [f for f in df.schema.fields if not f.name.startswith("_")]
        return df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *map(text, fields)).alias("content"))

    return reduce(DataFrame.unionByName, [rows(n, df) for n, df in _exported(spark, sf_dir)[0].items()])


def _whole_run(spark, sf_dir):
    """Topics to tested star schema in one go, with a date dimension that covers all orders."""
    stores.lines_first(spark, sf_dir)
    topics = {topic: stores.topic_stream(spark, sf_dir, topic) for topic in TOPICS}
    return run_lakehouse(
        spark, topics, work_path(spark, "run"), first=date(2019, 1, 1), last=date(2026, 12, 31), strict=False, buckets=BUCKETS
    )


@query
def full_run(spark, sf_dir):
    """The report of a whole run."""
    return _whole_run(spark, sf_dir).report


@query
def full_run_fact_orders(spark, sf_dir):
    """The lines a whole run publishes, from change messages on."""
    return _whole_run(spark, sf_dir).marts["fact_orders"]


@query
def full_run_dim_users(spark, sf_dir):
    """The users a whole run publishes, from change messages on."""
    return _whole_run(spark, sf_dir).marts["dim_users"]
