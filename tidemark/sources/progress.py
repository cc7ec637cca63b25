"""How far a job has read each raw table, kept beside what it wrote.

A mark is written after the data it stands for, and applying the same messages again changes nothing; so a crash in between costs
one repetition and nothing else.  What is read back is one row per topic partition, whatever the tables hold.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.clicks import new_rows
from tidemark.schemas import INGEST_DATE
from tidemark.sources.bronze import arrived_since
from tidemark.sources.tables import table_exists

_SCHEMA = "partition int, last_offset long, last_day date"


@dataclass(frozen=True)
class Marks:
    """Per topic partition the last offset read, and the last day on which any message came in."""

    offsets: Mapping[int, int] = field(default_factory=dict)
    day: date | None = None

    def rows_after(self, bronze: DataFrame) -> DataFrame:
        """Rows of a raw table beyond the marks.  Earlier days are not listed: their messages were all there when the last one's were read."""
        return new_rows(arrived_since(bronze, self.day), self.offsets)

    def advanced(self, fresh: DataFrame) -> Marks:
        """The marks after ``fresh`` has been read: two integer columns and the layout are looked at."""
        day = F.col(INGEST_DATE) if INGEST_DATE in fresh.columns else F.lit(None).cast("date")
        found = fresh.groupBy("partition").agg(F.max("offset").alias("offset"), F.max(day).alias("day")).collect()
        offsets = {r["partition"]: max(r["offset"], self.offsets.get(r["partition"], -1)) for r in found if r["partition"] is not None}
        days = [d for d in (self.day, *(r["day"] for r in found)) if d is not None]
        return Marks({**self.offsets, **offsets}, max(days, default=None))


class Progress:
    """The marks of one job on one raw table, a small file per change."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def next_run(self) -> int:
        """A number for what is written before the next marks; a run that fails is given the same one again."""
        return self._version() + 1

    def _version(self) -> int:
        if not table_exists(self.spark, self.path, schema=_SCHEMA):
            return -1
        files = self.spark.read.schema(_SCHEMA).parquet(self.path).inputFiles()
        return max((int(re.search(r"/v=(\d+)/", name)[1]) for name in files), default=-1)

    def read(self) -> Marks | None:
        """The latest marks; None before the first."""
        version = self._version()
        if version < 0:
            return None
        rows = self.spark.read.schema(_SCHEMA).parquet(f"{self.path}/v={version}").collect()
        return Marks({r["partition"]: r["last_offset"] for r in rows}, max((r["last_day"] for r in rows if r["last_day"]), default=None))

    def write(self, marks: Marks) -> None:
        if not marks.offsets:
            return
        rows = self.spark.createDataFrame([(p, o, marks.day) for p, o in marks.offsets.items()], _SCHEMA)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/v={self.next_run()}")
