"""Version history that grows with the changes: a run closes the versions that were open and appends, and rewrites nothing else.

The last change of each key is kept in a keyed table, as an open version.  A run chains the new changes of a key to it: all but the
last become closed versions in a folder of the run's own, the last one is the new open version.  A change that comes late, behind the
key's open version (its topic partition was read later), falls among versions that are closed already; those keys are chained anew from
all their versions, and those that come out different are written as corrections, which readers put in their place.  So the
result is that of ``change_history`` over all messages, however they arrive, and messages that come again change nothing.

What a run uses several times it writes below ``_work``, where the next run overwrites it; so each step's shuffles go when the step ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.decode import decode_field
from tidemark.operators.changes import HISTORY_SLICE, KEY, chained, parse_envelope
from tidemark.schemas import CHANGED_AT, DELETED, LINEAGE, MARKS, TableSpec
from tidemark.sources.snapshots import SnapshotTable
from tidemark.sources.tables import table_exists

_POSITION = (CHANGED_AT, *LINEAGE)
_TO = "valid_to"
_WAS = "_was"


class History:
    """The history of one table below ``root``."""

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec, buckets: int = 64):
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec
        self.open = SnapshotTable(spark, f"{self.root}/open", spec.silver_schema, spec.key, buckets, MARKS)
        self._version_columns = [*spec.silver_schema.names, CHANGED_AT, DELETED]
        self._closed = T.StructType([*self.open.stored.fields, T.StructField(_TO, T.TimestampType()), T.StructField("run", T.LongType())])

    # -- reading ---------------------------------------------------------------------------------------------------
    def _stored(self, kind: str, runs: int) -> DataFrame:
        """Closed versions or corrections of the runs that were finished."""
        path = f"{self.root}/{kind}"
        if runs < 0 or not table_exists(self.spark, path, schema=self._closed):
            return self.spark.createDataFrame([], self._closed)
        return self.spark.read.schema(self._closed).parquet(path).filter(F.col("run") <= runs)

    def _closed_versions(self, runs: int) -> DataFrame:
        """Closed versions as they are now: the last correction of each in place of what it corrects."""
        fixed = self._stored("corrections", runs)
        identity = [self.spec.key, *LINEAGE]
        newest = Window.partitionBy(*identity).orderBy(F.desc("run"))
        fixed = fixed.withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth")
        closed = self._stored("closed", runs)
        return closed.join(fixed.select(*identity), identity, "left_anti").unionByName(fixed).drop("run")

    def read(self) -> DataFrame:
        """Every version: typed columns, lineage, ``valid_from``, ``valid_to``, ``is_current``."""
        pointer = self.open.pointer()
        current = self.open.read_stored(pointer=pointer).withColumn(_TO, F.lit(None).cast("timestamp"))
        versions = self._closed_versions(pointer.version).unionByName(current).filter(~F.coalesce(DELETED, F.lit(False)))
        return versions.select(
            *self.spec.silver_schema.names, F.col(CHANGED_AT).alias("valid_from"), _TO, F.col(_TO).isNull().alias("is_current")
        )

    # -- writing ---------------------------------------------------------------------------------------------------
    def _changes(self, bronze: DataFrame) -> DataFrame:
        """All changes as versions; what has no after-image ends the version before it."""
        spec = self.spec
        typed = [(F.col(KEY) if f.name == spec.key else decode_field(f, F.col(f"after.{f.name}"))).alias(f.name) for f in spec.fields]
        position = [F.col(c).alias(name) for c, name in zip(("partition", "offset", "timestamp"), (*LINEAGE, CHANGED_AT))]
        gone = F.coalesce((F.col("op") == "d") | F.col("after").isNull(), F.lit(False))
        return parse_envelope(bronze, spec, before=()).select(*typed, *position, gone.alias(DELETED))

    def _worked(self, name: str, rows: DataFrame) -> DataFrame:
        """``rows`` as written for the steps that follow in this run."""
        path = f"{self.root}/_work/{name}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def extend(self, bronze: DataFrame, slice_seconds: int = HISTORY_SLICE) -> int:
        """Take in raw changes as one run; returns its number.  A run that fails leaves the history as it was."""
        key, pointer = self.spec.key, self.open.pointer()
        run = pointer.version + 1
        identity = [key, *LINEAGE]
        changes = self._worked("changes", self._changes(bronze).dropDuplicates(identity))
        buckets = self.open.touched(changes)
        if not buckets:
            return pointer.version
        # The open versions meet the first change of their key, once.
        position = F.struct(*[F.col(c) for c in _POSITION])
        first = changes.groupBy(key).agg(F.min(position).alias("_first"))
        stored = self.open.read_stored(buckets, pointer).select(*self._version_columns).join(first, key, "left")
        behind = F.coalesce(F.col("_first") <= position, F.lit(False))
        met = F.col("_first").isNotNull().alias("_met")
        stored = self._worked("stored", stored.select(*self._version_columns, met, behind.alias("_late")))
        late = stored.filter("_late").select(key).distinct()
        any_late = bool(late.take(1))
        as_change = {_WAS: F.lit(None).cast("timestamp"), "_late": F.lit(False)}
        again = stored.filter("_met").drop("_met").withColumn(_WAS, as_change[_WAS])
        if any_late:
            # A version that comes again is known by its position; the stored one says where it ended.
            before = self._closed_versions(pointer.version).join(late, key, "left_semi").withColumnRenamed(_TO, _WAS)
            before = self._worked("before", before.withColumn("_late", F.lit(True)))
            again = again.unionByName(before)
            same = [F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in identity]
            unseen = changes.alias("s").join(again.select(*identity).alias("t"), same, "left_anti")
            changes = self._worked("unseen", unseen)
        rows = changes.withColumns(as_change).unionByName(again)
        # Chained once: what ended, what is corrected and what is open are read from it.
        chain = chained(rows, key, CHANGED_AT, _POSITION, slice_seconds, "_late").withColumnRenamed("_next", _TO)
        chain = self._worked("chain", chain.filter(F.col(_TO).isNull() | ~F.col(_TO).eqNullSafe(F.col(_WAS))))
        ended = chain.filter(F.col(_TO).isNotNull())
        for kind, found in (("closed", ended.filter(~F.col("_late"))), ("corrections", ended.filter("_late"))):
            if kind == "closed" or any_late:
                found.select(*self._version_columns, _TO).write.mode("overwrite").parquet(f"{self.root}/{kind}/run={run}")
        newest = chain.filter(F.col(_TO).isNull())
        rows = [part.select(*self._version_columns) for part in (stored.filter(~F.col("_met")), newest)]
        return self.open.commit(rows[0].unionByName(rows[1]), buckets, None, pointer)
