"""Raw tables: append-only, laid out by the day their messages came in."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import BRONZE_SCHEMA, BRONZE_TABLE_SCHEMA, INGEST_DATE


def read_bronze(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """The messages of a raw table; with ``since`` only the days from that one on are listed and read.

    Tables without the layout by day are read as a whole.
    """
    return arrived_since(spark.read.schema(BRONZE_TABLE_SCHEMA).parquet(path), since).select(*BRONZE_SCHEMA.names)


def arrived_since(bronze: DataFrame, since: date | None) -> DataFrame:
    """Rows of a raw table that came in on that day or later, a filter on the layout; all, if there is none."""
    if since is None or INGEST_DATE not in bronze.columns:
        return bronze
    return bronze.filter((F.col(INGEST_DATE) >= F.lit(since)) | F.col(INGEST_DATE).isNull())


def bronze_table(spark: SparkSession, path: str) -> DataFrame:
    """A raw table with the day as a column, for those that keep track of days themselves (see ``Progress``)."""
    return spark.read.schema(BRONZE_TABLE_SCHEMA).parquet(path)


def stream_bronze(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """A raw table as a stream of its messages, at most ``limit`` files to a micro-batch."""
    reader = spark.readStream.schema(BRONZE_TABLE_SCHEMA)
    if limit is not None:
        reader = reader.option("maxFilesPerTrigger", limit)
    return reader.parquet(path).select(*BRONZE_SCHEMA.names)
