"""Current-state tables on plain Parquet, changed one version at a time.

A version is a set of hash buckets: a commit writes only the buckets the changes touch and then one small Parquet file that says
which version holds each bucket.  Readers follow that file, so they see either all of a commit or nothing of it, and a table is never
overwritten while it is being read.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import DELETED
from tidemark.sources.tables import table_exists

_BUCKET = "_bucket"
_POINTER_SCHEMA = "bucket int, version long, token string, buckets int"
_POINTER_FIELDS = "bucket:int,version:bigint,token:string,buckets:int"


@dataclass(frozen=True)
class Pointer:
    """A commit: its number, the token it was made under, and the version that holds each bucket."""

    version: int
    token: str | None
    buckets: dict[int, int]


class SnapshotTable:
    """A keyed table whose current version is named by a pointer file.

    ``buckets`` is fixed when the table is created and kept with each commit; another number is refused. Choose it so that one bucket is a few files, and make
    ``spark.sql.shuffle.partitions`` a multiple of it, so that a shuffle by key already lines up with the buckets.

    ``marks`` are further columns that are stored with each row; with them, rows marked ``_deleted`` are stored but not shown.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, key: str = "id", buckets: int = 64, marks: T.StructType | None = None
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.key = key
        self.buckets = buckets
        self.stored = T.StructType([*schema.fields, *(marks.fields if marks else [])])

    # -- pointer ---------------------------------------------------------------------------------------------------
    def _pointers(self) -> str:
        return f"{self.root}/pointer"

    def exists(self) -> bool:
        return table_exists(self.spark, self._pointers(), schema=_POINTER_SCHEMA)

    def pointer(self) -> Pointer:
        """The latest commit; an empty one of version -1 before the first."""
        if not self.exists():
            return Pointer(-1, None, {})
        files = self.spark.read.schema(_POINTER_SCHEMA).parquet(self._pointers()).inputFiles()
        version = max(int(re.search(r"/v=(\d+)/", name)[1]) for name in files)
        # One row per bucket at most.
        rows = self.spark.read.schema(_POINTER_SCHEMA).parquet(f"{self._pointers()}/v={version}").collect()
        if rows[0]["buckets"] != self.buckets:
            raise ValueError(f"{self.root} has {rows[0]['buckets']} buckets, not {self.buckets}")
        return Pointer(version, rows[0]["token"], {r["bucket"]: r["version"] for r in rows if r["bucket"] >= 0})

    def version(self) -> int:
        """Number of the latest commit, -1 before the first."""
        return self.pointer().version

    # -- reading ---------------------------------------------------------------------------------------------------
    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.hash(key), F.lit(self.buckets))

    def read(self, only: list[int] | None = None, pointer: Pointer | None = None) -> DataFrame:
        """The rows of the current (or the given) version, of some buckets or of all."""
        rows = self.read_stored(only, pointer)
        if DELETED not in rows.columns:
            return rows
        return rows.filter(~F.coalesce(DELETED, F.lit(False))).select(*self.schema.names)

    def read_stored(self, only: list[int] | None = None, pointer: Pointer | None = None) -> DataFrame:
        """Like ``read``, with marks and with what is marked as deleted; rows stored without marks have NULL there."""
        held = (pointer or self.pointer()).buckets
        wanted = held if only is None else {b: held[b] for b in only if b in held}
        if not wanted:
            return self.spark.createDataFrame([], self.stored)
        paths = [f"{self.root}/data/v={v}/{_BUCKET}={b}" for b, v in sorted(wanted.items())]
        return self.spark.read.schema(self.stored).parquet(*paths)

    def superseded(self) -> list[str]:
        """Files that the current version no longer uses, for a clean-up job to remove once no reader needs them."""
        every = self.spark.read.schema(self.schema).parquet(f"{self.root}/data").inputFiles()
        return sorted(set(every) - set(self.read().inputFiles()))

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets that hold the given keys; never more than ``buckets`` numbers."""
        rows = keys.select(self.bucket_of(F.col(self.key)).alias(_BUCKET)).distinct().collect()
        return sorted(r[_BUCKET] for r in rows)

    # -- writing ---------------------------------------------------------------------------------------------------
    def commit(
        self,
        rows: DataFrame,
        touched: list[int] | None = None,
        token: str | None = None,
        pointer: Pointer | None = None,
    ) -> int:
        """Replace the touched buckets (all, if not given) by ``rows`` and make that the current version.

        Without any rows a table that does not exist yet is not created either.

        A table has one writer; ``pointer`` is the version ``rows`` were made from, if already known.
        """
        latest = pointer or self.pointer()
        version = latest.version + 1
        folder = f"{self.root}/data/v={version}"
        bucketed = rows.select(*self.stored.names, self.bucket_of(F.col(self.key)).alias(_BUCKET))
        bucketed.write.partitionBy(_BUCKET).mode("overwrite").parquet(folder)
        files = self.spark.read.schema(self.schema).parquet(folder).inputFiles()
        written = {int(re.search(rf"/{_BUCKET}=(\d+)/", name)[1]) for name in files}
        if not written and latest.version < 0:
            return latest.version
        replaced = set(range(self.buckets)) if touched is None else set(touched)
        held = {b: v for b, v in latest.buckets.items() if b not in replaced}
        held.update({b: version for b in written})
        lines = [{"bucket": b, "version": v, "token": token, "buckets": self.buckets} for b, v in [(-1, version), *sorted(held.items())]]
        rows_of = F.inline(F.from_json(F.lit(json.dumps(lines)), f"array<struct<{_POINTER_FIELDS}>>"))
        self.spark.range(0, 1, 1, 1).select(rows_of).write.mode("overwrite").parquet(f"{self._pointers()}/v={version}")
        return version
