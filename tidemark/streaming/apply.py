"""Keeping current-state tables up to date from raw change tables."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changes import OUTCOMES, first_load, latest_typed_changes, merge_stored, observed
from tidemark.operators.clicks import high_water
from tidemark.schemas import TableSpec
from tidemark.sources.progress import Marks, Progress
from tidemark.sources.snapshots import SnapshotTable


def nothing() -> dict[str, int]:
    return dict.fromkeys(OUTCOMES, 0)


def apply_batch(bronze: DataFrame, spec: TableSpec, target: SnapshotTable, token: str | None = None) -> dict[str, int]:
    """Apply a set of raw changes to ``target`` as one commit; returns ``inserted, updated, deleted``.

    Only the latest change per key is kept, and only the buckets those keys fall into are read and rewritten.  What happened is
    observed on the rows as they are written, so it costs no job of its own.
    """
    pointer = target.pointer()
    if token is not None and pointer.token == token:
        return nothing()
    changes = latest_typed_changes(bronze, spec)
    if pointer.version < 0:
        # Nothing to merge with: one pass from raw messages to stored rows.
        rows, counts = observed(first_load(changes))
        target.commit(rows, None, token, pointer)
        return counts.get
    # The changes are used twice; they are recomputed from the raw rows should an executor be lost.
    changes = changes.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        buckets = target.touched(changes)
        if not buckets:
            return nothing()
        rows, counts = observed(merge_stored(target.read_stored(buckets, pointer), changes, spec.key))
        target.commit(rows, buckets, token, pointer)
        return counts.get
    finally:
        changes.unpersist()


def refresh_table(bronze: DataFrame, spec: TableSpec, target: SnapshotTable, progress: Progress | None = None) -> dict[str, int]:
    """Batch form: apply what the raw table holds beyond what has been applied; returns ``inserted, updated, deleted``.

    A raw table grows in offset order within a topic partition and a refresh takes all of it, so whatever lies below the last
    offset of its partition has been applied.  With ``progress`` the offsets are kept there, and a refresh reads neither earlier
    days of the raw table nor a row of the stored one to learn them.  Without it, or before its first marks, the stored rows tell.
    (Keys that moved to another partition leave no offset behind in their old one; reading their old messages again changes nothing.)
    """
    marks = known_marks(progress, target)
    fresh = marks.rows_after(bronze)
    after = marks.advanced(fresh) if progress else marks
    if progress and after.offsets == marks.offsets:
        return nothing()
    result = apply_batch(fresh, spec, target)
    if progress:
        progress.write(after)
    return result


def known_marks(progress: Progress | None, target: SnapshotTable) -> Marks:
    """The marks that are kept, else those that the stored rows give, else none."""
    marks = progress.read() if progress else None
    if marks is None and target.exists():
        found = high_water(target.read_stored()).collect()
        marks = Marks({r["partition"]: r["last_offset"] for r in found if r["partition"] is not None})
    return marks or Marks()


def apply_cdc_stream(bronze: DataFrame, spec: TableSpec, target: SnapshotTable, checkpoint: str) -> StreamingQuery:
    """Streaming form: apply what is new since the checkpoint, one commit per micro-batch.

    A micro-batch that is run again after its commit is recognised by its token and skipped.  The token holds the query's id,
    which lives in the checkpoint: after a reset numbers begin anew, but under another id.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        apply_batch(batch, spec, target, token=f"{query}#{batch_id}")

    return (
        bronze.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
