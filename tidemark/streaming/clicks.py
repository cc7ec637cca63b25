"""Streaming clickstream: refinement, stage counts and visit sessions."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.clicks import event_key, first_per_event, not_stored, parse_clicks
from tidemark.schemas import CLICK_SILVER_SCHEMA
from tidemark.sources.tables import read_table, table_exists


def refine_clickstream_stream(spark: SparkSession, bronze: DataFrame, silver_path: str, checkpoint: str) -> StreamingQuery:
    """Append the events that are new since the checkpoint to the Silver table, each ``event_id`` once.

    Copies inside a micro-batch are combined before the shuffle; copies of events stored earlier are found by joining
    the table itself.  No streaming state is kept, so nothing is dropped for being late and no copy is ever forgotten.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        # Used twice below; recomputed from the raw rows should an executor be lost.
        fresh = once = first_per_event(parse_clicks(batch)).persist(StorageLevel.MEMORY_AND_DISK)
        if table_exists(spark, silver_path, schema=CLICK_SILVER_SCHEMA):
            fresh = not_stored(fresh, read_table(spark, silver_path, schema=CLICK_SILVER_SCHEMA))
        fresh.write.mode("append").parquet(silver_path)
        once.unpersist()

    return (
        bronze.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_deliveries(bronze: DataFrame, delay: str = "7 days") -> DataFrame:
    """Events of a raw stream, each once, without a look at what is stored: state is kept of the events of the last ``delay`` only.

    The clock is the time of the messages.  A copy that comes within ``delay`` of the event's first delivery is recognised; messages
    further behind the latest than that are left out, copies and others alike, since nothing is known about them any more.  How
    many of either there were says ``deliveries``.  Where nothing may be left out use ``refine_clickstream_stream``.
    """
    typed = parse_clicks(bronze, delivered="_delivered").withColumn("_event", event_key())
    once = typed.withWatermark("_delivered", delay).dropDuplicatesWithinWatermark(["_event"])
    return once.select(*CLICK_SILVER_SCHEMA.names)


def deliveries(query: StreamingQuery) -> dict[str, int]:
    """Of a finished run of ``first_deliveries``: messages read, copies recognised, messages left out for being late."""
    found = {"messages": 0, "copies": 0, "late": 0}
    for progress in query.recentProgress:
        found["messages"] += progress["numInputRows"]
        for operator in progress["stateOperators"]:
            found["copies"] += operator["customMetrics"].get("numDroppedDuplicateRows", 0)
            found["late"] += operator["numRowsDroppedByWatermark"]
    return found


def stage_counts(clicks: DataFrame, lateness: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Events per type and tumbling window; a window is emitted once the watermark has passed its end."""
    return (
        clicks.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", width).alias("span"), "event_type")
        .agg(F.count(F.lit(1)).alias("events"))
        .select(
            F.col("span.start").alias("window_start"),
            F.col("span.end").alias("window_end"),
            "event_type",
            "events",
        )
    )


def visit_sessions(clicks: DataFrame, lateness: str = "1 hour", gap: str = "30 minutes") -> DataFrame:
    """Visits per user; a visit is emitted once the watermark has passed its end.

    ``session.configure`` has Spark merge events into sessions before they are shuffled, so a busy user sends few rows.
    """
    return (
        clicks.withWatermark("timestamp", lateness)
        .groupBy(F.session_window("timestamp", gap).alias("span"), "user_id")
        .agg(F.count(F.lit(1)).alias("events"), F.max("timestamp").alias("session_end"))
        .select("user_id", F.col("span.start").alias("session_start"), "session_end", "events")
    )
