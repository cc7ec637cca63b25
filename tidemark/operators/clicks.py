"""Clickstream: reading progress per topic partition, parsing and de-duplication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import decode_columns
from tidemark.schemas import CLICK_FIELDS, LINEAGE


def high_water(silver: DataFrame) -> DataFrame:
    """Last processed offset of each topic partition; a partition never seen has no row (read it as -1)."""
    partition, offset = LINEAGE
    return silver.groupBy(F.col(partition).alias("partition")).agg(F.max(offset).alias("last_offset"))


def _any(tests: list[Column]) -> Column:
    """Either of the tests, as a tree that is no deeper than it must be."""
    half = len(tests) // 2
    return _any(tests[:half]) | _any(tests[half:]) if half else tests[0]


def new_rows(bronze: DataFrame, progress: DataFrame | Mapping[int, int]) -> DataFrame:
    """Bronze rows beyond the high-water mark of their partition; a partition without a mark is new altogether.

    ``progress`` has the last offset of each topic partition; as a table it is read here.  It becomes a predicate that skips row groups.
    """
    if isinstance(progress, DataFrame):
        progress = {m["partition"]: m["last_offset"] for m in progress.collect() if m["partition"] is not None}
    if not progress:
        return bronze
    unseen = F.col("partition").isNull() | ~F.col("partition").isin(list(progress))
    beyond = _any([(F.col("partition") == p) & (F.col("offset") > last) for p, last in progress.items()])
    return bronze.filter(beyond | unseen)


def parse_clicks(bronze: DataFrame, delivered: str | None = None) -> DataFrame:
    """Raw event messages -> typed columns with lineage, and the message's own time if that is given a name."""
    wire = T.StructType([T.StructField(f.name, T.StringType()) for f in CLICK_FIELDS])
    extra = [F.col("timestamp").alias(delivered)] if delivered else []
    parsed = bronze.select(F.inline(F.array(F.from_json("value", wire))), "partition", "offset", *extra)
    return decode_columns(
        parsed,
        CLICK_FIELDS,
        keep=(F.col("partition").alias(LINEAGE[0]), F.col("offset").alias(LINEAGE[1]), *([delivered] if delivered else [])),
    )


def event_key() -> Column:
    """What tells events apart: their id, and the position of those that have none (behind a sign that ids do not begin with)."""
    position = F.concat_ws("/", F.lit("\0"), *[F.col(c).cast("string") for c in LINEAGE])
    return F.coalesce("event_id", position)


def not_stored(fresh: DataFrame, silver: DataFrame) -> DataFrame:
    """Events of ``fresh`` that Silver does not hold, with or without an id.

    Silver is first reduced to the offered keys, so that the (small) batch and not the whole table may be broadcast.
    """
    keyed = fresh.withColumn("_event", event_key())
    seen = silver.select(event_key().alias("_event")).join(keyed.select("_event"), "_event", "left_semi")
    return keyed.join(seen, "_event", "left_anti").select(*fresh.columns)


def first_per_event(clicks: DataFrame) -> DataFrame:
    """One row per ``event_id``: the first delivered.  Applied before the shuffle too, so many copies cost little.

    Events without an id are told apart by their position, so each of them stays.
    """
    partition, offset = LINEAGE
    unnamed = F.when(F.col("event_id").isNull(), F.struct(partition, offset))
    earliest = Window.partitionBy("event_id", unnamed).orderBy(offset, partition)
    return clicks.withColumn("_rank", F.row_number().over(earliest)).filter(F.col("_rank") == 1).drop("_rank")


def refine_clickstream(bronze: DataFrame, silver: DataFrame | None = None, progress: Mapping[int, int] | None = None) -> DataFrame:
    """Events of ``bronze`` that Silver does not hold yet, typed, one row per event.

    Without Silver: everything.  With it: only rows beyond the marks in ``progress`` (Silver's own high-water mark, if none are
    given), and of those only events it has not already stored from an earlier delivery.
    """
    if silver is None:
        return first_per_event(parse_clicks(bronze))
    marks = high_water(silver) if progress is None else progress
    return not_stored(first_per_event(parse_clicks(new_rows(bronze, marks))), silver)
