"""Change-data-capture: envelopes, what cannot be applied, latest state per key, merges and version history."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.decode import decode_field
from tidemark.schemas import CHANGED_AT, DELETED, LINEAGE, Field, TableSpec

KEY = "row_key"
# The order of a key's changes: time between partitions; inside one it does not go backwards, so the offset decides there.
POSITION = ("timestamp", "partition", "offset")
# Seconds covered by one slice of a key's history: the rows of a key that meet in one task.
HISTORY_SLICE = 86_400


# Why a raw message is not applied, in the order the reasons are looked for.
REJECTS = ("tombstone", "malformed", "no_payload", "no_key")


def parse_messages(
    bronze: DataFrame, spec: TableSpec, before: Sequence[str] | None = None, keep: Sequence[str] = (), after: Sequence[str] | None = None
) -> DataFrame:
    """Raw change messages -> ``row_key, op, before, after, partition, offset, timestamp, reason`` and what to ``keep``.

    ``before`` and ``after`` hold wire text; name the columns of either that are needed to leave the rest unread.
    The key comes from ``after`` and, for a delete, which has none, from ``before``.  ``reason`` says why a message cannot be applied
    and is NULL for one that can.  Keys, reasons and images come from one parse.
    """
    wire = spec.wire_schema

    def image_of(columns: Sequence[str] | None) -> T.StructType:
        return wire if columns is None else T.StructType([f for f in wire.fields if f.name in {spec.key, *columns}])

    payload = T.StructType(
        [
            T.StructField("before", image_of(before)),
            T.StructField("after", image_of(after)),
            T.StructField("op", T.StringType()),
        ]
    )
    schema = T.StructType([T.StructField("payload", payload), T.StructField("_unread", T.StringType())])
    message = F.from_json("value", schema, {"columnNameOfCorruptRecord": "_unread"})
    # Unpacked by a generator: a filter on the key or the reason would otherwise be pushed below the projection together with a
    # second copy of the parser.
    whole = F.struct(message.alias("message"), F.col("value").isNull().alias("empty"))
    parsed = bronze.select(F.inline(F.array(whole)), "partition", "offset", "timestamp", *keep)
    image = F.col("message.payload")
    key = F.coalesce(image["after"][spec.key], image["before"][spec.key]).try_cast("bigint")
    reason = (
        F.when(F.col("empty"), REJECTS[0])
        .when(F.col("message").isNull() | F.col("message._unread").isNotNull(), REJECTS[1])
        .when(image.isNull(), REJECTS[2])
        .when(key.isNull(), REJECTS[3])
    )
    fields = [image[c].alias(c) for c in ("op", "before", "after")]
    return parsed.select(key.alias(KEY), *fields, "partition", "offset", "timestamp", reason.alias("reason"), *keep)


def parse_envelope(bronze: DataFrame, spec: TableSpec, before: Sequence[str] | None = None) -> DataFrame:
    """Raw change messages that can be applied: ``row_key, op, before, after, partition, offset, timestamp``."""
    return parse_messages(bronze, spec, before).filter("reason IS NULL").drop("reason")


def latest_per_key(changes: DataFrame, key: str | Sequence[str] = KEY, order: Sequence[str] = POSITION) -> DataFrame:
    """The last row of each key in the given order.

    Spark applies the limit of one row per key before the shuffle as well, so a key with very many versions sends one
    row per map task.
    """
    newest = Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*[F.desc(c) for c in order])
    return changes.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")


def latest_changes(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """The last change of each key in a raw table, reduced to what applying it needs.

    Inside a topic partition the offset decides, between a key's partitions the message time of the last change in each.
    """
    changes = parse_envelope(bronze, spec, before=()).select(KEY, "op", "after", "partition", "offset", "timestamp")
    return latest_per_key(latest_per_key(changes, (KEY, "partition"), ("offset",)), KEY, ("timestamp", "partition"))


def decode_columns(df: DataFrame, fields: Sequence[Field], image: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Wire text to typed columns in one projection; ``image`` names the struct that holds the text, if any."""
    prefix = f"{image}." if image else ""
    typed = [decode_field(f, F.col(f"{prefix}{f.name}")).alias(f.name) for f in fields]
    return df.select(*typed, *keep)


def _typed(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Changes as typed rows; ``_deleted`` is NULL for one that neither has an image nor is a delete."""
    deleted = (F.col("op") == "d") | F.col("after").isNull()
    applies = F.col("after").isNotNull() | (F.col("op") == "d")
    typed = [
        (F.col(KEY) if f.name == spec.key else decode_field(f, F.col(f"after.{f.name}"))).alias(f.name)
        for f in spec.fields
    ]
    return changes.select(
        *typed,
        F.col("partition").alias(LINEAGE[0]),
        F.col("offset").alias(LINEAGE[1]),
        F.col("timestamp").alias(CHANGED_AT),
        F.when(applies, F.coalesce(deleted, F.lit(False))).alias(DELETED),
    )


def typed_changes(latest: DataFrame, spec: TableSpec) -> DataFrame:
    """Latest changes as typed rows with lineage, message time and ``_deleted``; of a delete only the key is filled."""
    return _typed(latest, spec).filter(F.col(DELETED).isNotNull())


def latest_typed_changes(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """``typed_changes`` of ``latest_changes``, decoded before the shuffles: typed rows are smaller than images as text."""
    partition, offset = LINEAGE
    typed = _typed(parse_envelope(bronze, spec, before=()), spec)
    latest = latest_per_key(latest_per_key(typed, (spec.key, partition), (offset,)), spec.key, (CHANGED_AT, partition))
    return latest.filter(F.col(DELETED).isNotNull())


def split_changes(latest: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """Latest changes -> (typed rows to upsert, keys to delete), both with lineage columns."""
    changes = typed_changes(latest, spec)
    upserts = changes.filter(~F.col("_deleted")).drop("_deleted", CHANGED_AT)
    deletes = changes.filter("_deleted").select(spec.key, *LINEAGE)
    return upserts, deletes


#: What applying a change does to the rows that readers see.
OUTCOMES = ("inserted", "updated", "deleted")
OUTCOME = "_outcome"


def _outcome(deleted: Column, live: Column) -> Column:
    return F.when(~deleted & ~live, OUTCOMES[0]).when(~deleted, OUTCOMES[1]).when(live, OUTCOMES[2]).alias(OUTCOME)


def first_load(changes: DataFrame) -> DataFrame:
    """``typed_changes`` as the first rows of a table, with their ``_outcome``."""
    return changes.select("*", _outcome(F.col(DELETED), F.lit(False)))


def merge_stored(stored: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Stored rows after applying ``typed_changes``, at most one per key, with the ``_outcome`` of those that are new.

    Inside a partition the offset decides, between partitions the message time (at equal times the partition number, as in
    ``latest_changes``).  Rows stored without a time are older than a change from another partition.  A deleted key stays as a marker
    with the position of its delete, so that older messages, also of keys that moved to another partition, change nothing when applied
    again.  Both sides have one row per key and meet once.  Write the rows through ``observed`` to learn what happened from the write
    itself.
    """
    partition, offset = LINEAGE
    met = stored.alias("t").join(changes.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    later = F.struct(f"s.{CHANGED_AT}", f"s.{partition}") > F.struct(f"t.{CHANGED_AT}", f"t.{partition}")
    same = F.col(f"s.{partition}") == F.col(f"t.{partition}")
    applies = F.when(same, F.col(f"s.{offset}") > F.col(f"t.{offset}")).otherwise(later)
    fresh = F.col(f"s.{key}").isNotNull() & (F.col(f"t.{key}").isNull() | F.coalesce(applies, F.lit(True)))
    live = F.col(f"t.{key}").isNotNull() & ~F.coalesce(F.col(f"t.{DELETED}"), F.lit(False))
    outcome = F.when(fresh, _outcome(F.col(f"s.{DELETED}"), live)).alias(OUTCOME)
    return met.select(*[F.when(fresh, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in changes.columns], outcome)


def observed(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows without their ``_outcome``, and its counts (``inserted, updated, deleted``) once they have been written."""
    counts = Observation()
    return rows.observe(counts, *[F.count_if(F.col(OUTCOME) == o).alias(o) for o in OUTCOMES]).drop(OUTCOME), counts


def chained(rows: DataFrame, key: str, time: str, order: Sequence[str], slice_seconds: int, mark: str | None = None) -> DataFrame:
    """``rows`` with ``_next``: the time of the key's next row in the given order, which begins with the time, NULL for its last.

    Every key is cut into slices of time, so that no task gets more rows of a key than came in one: rows are chained within a
    slice, and the last one of a slice takes its end from the first row of the key's next slice.  A ``mark`` (a boolean column) that is
    set in any row of a key comes to all of them.
    """
    sliced = rows.withColumn("_slice", F.coalesce(F.floor(F.unix_seconds(time) / slice_seconds), F.lit(-(1 << 62))))
    within = Window.partitionBy(key, "_slice").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    # A slice's first time and its marks are combined before they are shuffled; a key has as many such rows as slices.
    marks = [F.max(mark).alias(mark)] if mark else []
    heads = sliced.groupBy(key, "_slice").agg(F.min(time).alias("_head"), *marks)
    slices = Window.partitionBy(key)
    over = [F.max(mark).over(slices).alias(mark)] if mark else []
    following = heads.select(key, "_slice", F.lead("_head").over(slices.orderBy("_slice")).alias("_after"), *over)
    chain = sliced.drop(*([mark] if mark else [])).withColumn("_lead", F.lead(time).over(within))
    joined = chain.join(following, [key, "_slice"], "left").withColumn("_next", F.coalesce("_lead", "_after"))
    return joined.drop("_slice", "_lead", "_after")


def change_history(bronze: DataFrame, spec: TableSpec, slice_seconds: int = HISTORY_SLICE) -> DataFrame:
    """Every version of every row: typed columns, lineage, ``valid_from``, ``valid_to``, ``is_current``.

    A version ends when the next change of its key comes, be it an update or a delete.  As in ``latest_changes`` the offset decides
    inside a topic partition and the message time between partitions, time not going backwards for a key inside a partition.
    """
    changes = parse_envelope(bronze, spec, before=()).drop("before")
    versions = chained(changes, KEY, "timestamp", POSITION, slice_seconds).filter(F.col("after").isNotNull() & (F.col("op") != "d"))
    return decode_columns(
        versions,
        spec.fields,
        "after",
        keep=(
            F.col("partition").alias(LINEAGE[0]),
            F.col("offset").alias(LINEAGE[1]),
            F.col("timestamp").alias("valid_from"),
            F.col("_next").alias("valid_to"),
            F.col("_next").isNull().alias("is_current"),
        ),
    )


def decode_failures(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """Per typed column, how many after-images hold text that does not decode: ``table_name, column_name, failures``."""
    images = parse_envelope(bronze, spec, before=()).filter(F.col("after").isNotNull())
    checked = [f for f in spec.fields if f.kind != "string"]
    counts = images.agg(
        *[
            F.count_if(F.col(f"after.{f.name}").isNotNull() & decode_field(f, F.col(f"after.{f.name}")).isNull()).alias(
                f.name
            )
            for f in checked
        ]
    )
    pairs = reduce(lambda acc, f: acc + [F.lit(f.name), F.col(f.name)], checked, [])
    return counts.select(F.explode(F.create_map(*pairs)).alias("column_name", "failures")).select(
        F.lit(spec.name).alias("table_name"), "column_name", "failures"
    )


def rejects(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """The raw messages that are not applied, whole and with their ``reason``, to be kept or looked into."""
    rest = [c for c in bronze.columns if c not in ("partition", "offset", "timestamp")]
    found = parse_messages(bronze, spec, before=(), keep=rest, after=()).filter("reason IS NOT NULL")
    return found.select(*bronze.columns, "reason")


def reason_counts() -> list[Column]:
    """One count for each reason, over rows that have a ``reason``."""
    return [F.count_if(F.col("reason") == reason).alias(reason) for reason in REJECTS]


def reject_counts(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """How many raw messages are not applied, by reason: ``table_name, reason, messages``; reasons not met have 0."""
    counts = parse_messages(bronze, spec, before=(), after=()).agg(*reason_counts())
    lines = F.array(*[F.struct(F.lit(r).alias("reason"), F.col(r).alias("messages")) for r in REJECTS])
    return counts.select(F.inline(lines)).select(F.lit(spec.name).alias("table_name"), "reason", "messages")
