"""Parquet export."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import side_by_side
from tidemark.sources.published import Published


def export_tables(tables: Mapping[str, DataFrame], folder: str, files: int | None = None) -> dict[str, int]:
    """Export the tables below ``folder`` as one publication; returns the rows written of each.

    ``files`` fixes the number of files of a table: ``files=1`` is for small tables whose reader wants a single file.  By default
    a table keeps the parallelism it has.  An export that fails leaves the one before it as it is, also for those who read it.
    """
    written = Published(SparkSession.active(), folder).publish(tables, files)
    # Counted from the footers of what was written.
    return side_by_side({name: written[name].count for name in tables})


def exported(spark: SparkSession, folder: str) -> Published:
    """The exports below ``folder``: ``path`` says where the current one of a table is."""
    return Published(spark, folder)
