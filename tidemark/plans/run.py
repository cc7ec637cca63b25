"""The whole refresh: raw, current state, star schema, data tests."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.checks import CHECKS, run_suite
from tidemark.operators.changes import reason_counts, rejects
from tidemark.operators.clicks import high_water, refine_clickstream
from tidemark.plans.marts import FIRST_DAY, LAST_DAY, MARTS, star_models, write_marts
from tidemark.plans.models import resolve
from tidemark.plans.staging import STAGING
from tidemark.schemas import CDC_TABLES, CLICK_SILVER_SCHEMA, CLICK_TOPIC, MARKS, TableSpec
from tidemark.session import side_by_side
from tidemark.sources.bronze import bronze_table
from tidemark.sources.progress import Marks, Progress
from tidemark.sources.published import Published
from tidemark.sources.snapshots import SnapshotTable
from tidemark.sources.tables import SourceBinding, read_table, table_exists
from tidemark.streaming.apply import apply_batch, known_marks, nothing
from tidemark.streaming.landing import land_topics


class ChecksFailed(Exception):
    """Raised by a strict run whose data tests found violations."""

    def __init__(self, failed: list[str]):
        super().__init__(f"{len(failed)} checks failed: {', '.join(failed)}")
        self.failed = failed


@dataclass(frozen=True)
class RunResult:
    changes: dict[str, dict[str, int]]
    marts: dict[str, DataFrame]
    report: DataFrame


def silver_table(spark: SparkSession, folder: str, spec: TableSpec, buckets: int = 64) -> SnapshotTable:
    """The current-state table of ``spec`` below ``folder``."""
    return SnapshotTable(spark, f"{folder.rstrip('/')}/{spec.name}", spec.silver_schema, spec.key, buckets, MARKS)


def _refresh_table(spark: SparkSession, bronze: DataFrame, folder: str, spec: TableSpec, buckets: int) -> dict[str, int]:
    """Apply what is new to one table, and keep the new messages that cannot be applied; counts of both come from the writes."""
    target = silver_table(spark, folder, spec, buckets)
    progress = Progress(spark, f"{folder}/_progress/{spec.name}")
    marks = known_marks(progress, target)
    fresh = marks.rows_after(bronze)
    after = marks.advanced(fresh)
    if after.offsets == marks.offsets:
        return nothing()
    refused = Observation()
    reasons = reason_counts()
    kept = f"{folder}/_rejects/{spec.name}/run={progress.next_run()}"
    rejects(fresh, spec).observe(refused, *reasons).write.mode("overwrite").parquet(kept)
    result = apply_batch(fresh, spec, target)
    progress.write(after)
    return {**result, **{reason: n for reason, n in refused.get.items() if n}}


def _refresh_clicks(spark: SparkSession, bronze: DataFrame, folder: str) -> dict[str, int]:
    """Append the events that are new; their counts come from the write."""
    path = f"{folder}/clickstream"
    progress = Progress(spark, f"{folder}/_progress/clickstream")
    silver = None
    if table_exists(spark, path, schema=CLICK_SILVER_SCHEMA):
        silver = read_table(spark, path, schema=CLICK_SILVER_SCHEMA)
    marks = progress.read()
    if marks is None and silver is not None:
        found = high_water(silver).collect()
        marks = Marks({r["partition"]: r["last_offset"] for r in found if r["partition"] is not None})
    marks = marks or Marks()
    fresh = marks.rows_after(bronze)
    after = marks.advanced(fresh)
    counts = Observation()
    unnamed = F.count_if(F.col("event_id").isNull()).alias("without_id")
    rows = refine_clickstream(fresh, silver, {}).observe(counts, F.count(F.lit(1)).alias("inserted"), unnamed)
    rows.write.mode("append").parquet(path)
    progress.write(after)
    found = counts.get
    return {**nothing(), "inserted": found["inserted"], **({"without_id": found["without_id"]} if found["without_id"] else {})}


def refresh_silver(spark: SparkSession, bronze: Mapping[str, DataFrame], folder: str, buckets: int = 64) -> dict[str, dict[str, int]]:
    """Bring every current-state table and the event table up to date; returns per table what changed and what was refused, by reason.

    ``bronze`` holds the raw tables as ``bronze_table`` reads them: how far each has been read is kept below ``folder``, and only what
    came in since the day of the last refresh is listed and read.  Messages that cannot be applied are kept below ``_rejects``.
    """
    root = folder.rstrip("/")

    def table(spec: TableSpec) -> Callable[[], dict[str, int]]:
        return lambda: _refresh_table(spark, bronze[spec.topic], root, spec, buckets)

    changes = side_by_side(
        {"clickstream": lambda: _refresh_clicks(spark, bronze[CLICK_TOPIC], root), **{n: table(s) for n, s in CDC_TABLES.items()}}
    )
    return {name: changes[name] for name in ("clickstream", *CDC_TABLES)}


def silver_sources(folder: str, buckets: int = 64) -> SourceBinding:
    """The current-state tables and the event table below ``folder``, by name."""
    root = folder.rstrip("/")

    def opened(spark: SparkSession, name: str, path: str) -> DataFrame:
        if name in CDC_TABLES:
            return silver_table(spark, root, CDC_TABLES[name], buckets).read()
        return read_table(spark, path, schema=CLICK_SILVER_SCHEMA)

    return SourceBinding(root.replace("{", "{{").replace("}", "}}") + "/{name}", (*CDC_TABLES, "clickstream"), opener=opened)


def read_silver(spark: SparkSession, folder: str, buckets: int = 64) -> dict[str, DataFrame]:
    """All current-state tables and the event table as stored below ``folder``."""
    sources = silver_sources(folder, buckets)
    return {name: sources.read(spark, name) for name in sources.names}


def run_lakehouse(
    spark: SparkSession,
    topics: Mapping[str, DataFrame],
    folder: str,
    *,
    first: date = FIRST_DAY,
    last: date = LAST_DAY,
    strict: bool = True,
    buckets: int = 64,
) -> RunResult:
    """Land the topic streams, refresh the tables, rebuild the star schema and test it; stops at the first failure."""
    root = folder.rstrip("/")
    paths = land_topics(topics, f"{root}/bronze")
    bronze = {topic: bronze_table(spark, path) for topic, path in paths.items()}
    changes = refresh_silver(spark, bronze, f"{root}/silver", buckets)
    tables = resolve(silver_sources(f"{root}/silver", buckets).openers(spark), star_models(first, last))
    marts = write_marts(spark, {name: tables[name] for name in MARTS}, f"{root}/gold", buckets=buckets)
    staging = {name: tables[name] for name in STAGING}
    report = Published(spark, f"{root}/report").publish({"report": run_suite({**staging, **marts}, CHECKS)})["report"]
    if strict:
        failed = [row["check_name"] for row in report.filter(~report.passed).select("check_name").collect()]
        if failed:
            raise ChecksFailed(sorted(failed))
    return RunResult(changes, marts, report)
