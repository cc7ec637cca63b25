"""Landing topics as raw append-only tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.schemas import BRONZE_SCHEMA, INGEST_DATE


def to_bronze(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Topic messages as raw rows: text key and value, their position, and when they came in (now, unless a backfill says otherwise)."""
    return messages.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
    ).select(*BRONZE_SCHEMA.names)


def write_stream(
    stream: DataFrame, out: str, checkpoint: str, *, fmt: str = "parquet", name: str | None = None, by: Sequence[str] = ()
) -> StreamingQuery:
    """Append everything now available to ``out`` and stop; the checkpoint remembers what has been read.

    A source with a limit is read in as many micro-batches as it takes.  ``by`` names the columns the files are laid out by.
    """
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if by:
        writer = writer.partitionBy(*by)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True).start(out)


def land_topic(
    messages: DataFrame, out: str, checkpoint: str, *, fmt: str = "parquet", ingested_at: Column | None = None
) -> StreamingQuery:
    """Start landing one topic stream (see ``read_topic``) as a raw table laid out by the day messages come in."""
    rows = to_bronze(messages, ingested_at).withColumn(INGEST_DATE, F.to_date("ingested_at"))
    return write_stream(rows, out, checkpoint, fmt=fmt, by=[INGEST_DATE])


def land_topics(topics: Mapping[str, DataFrame], folder: str, *, fmt: str = "parquet") -> dict[str, str]:
    """Land several topics at the same time, each with its own checkpoint, and wait for all; returns their paths.

    If one fails the others still finish, then the failure is raised.
    """
    root = folder.rstrip("/")
    paths = {topic: f"{root}/{topic}" for topic in topics}
    running = [
        land_topic(stream, paths[topic], f"{root}/_checkpoints/{topic}", fmt=fmt) for topic, stream in topics.items()
    ]
    failures = []
    for query in running:
        try:
            query.awaitTermination()
        except Exception as error:  # noqa: BLE001 - raised below, once every query has ended
            failures.append(error)
    if failures:
        raise failures[0]
    return paths
