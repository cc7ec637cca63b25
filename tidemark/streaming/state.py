"""Current state as a streaming aggregate: a micro-batch touches the keys it changes and nothing else.

The state store holds the last change of every key.  Each micro-batch appends the keys it changed, as they are now, to a log; the
current state is the last entry of each key.  Nothing that is stored is read or rewritten while changes come in, so the cost of a
batch follows its changes and not the table.  ``compact_state`` folds the log into one entry per key whenever reading it gets slow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changes import KEY, POSITION, latest_per_key, parse_envelope, typed_changes
from tidemark.schemas import CHANGED_AT, DELETED, LINEAGE, MARKS, TableSpec
from tidemark.sources.tables import table_exists

_STORED = (CHANGED_AT, *LINEAGE)


def latest_in_state(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """The last change of each key of a stream (or table) of raw messages, as ``typed_changes``; as a stream in update mode.

    Inside a topic partition the offset decides, between partitions the message time, which does not go backwards for a key
    inside a partition.
    """
    changes = parse_envelope(bronze, spec, before=())
    # The change begins with its position, so that the state holds that once.
    last = changes.groupBy(KEY).agg(F.max(F.struct(*POSITION, "op", "after")).alias("last")).select(KEY, "last.*")
    return typed_changes(last, spec)


def _schema(spec: TableSpec) -> T.StructType:
    return T.StructType([*spec.silver_schema.fields, *MARKS.fields])


def keep_state(bronze: DataFrame, spec: TableSpec, out: str, checkpoint: str) -> StreamingQuery:
    """Append the keys that are changed by what is now available, one folder of the log to each micro-batch.

    A batch that is run again replaces its folder.  Folders carry the query's id, so one with a new checkpoint, which reads everything
    again, writes beside what is there; entries alike in position are alike in content.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.select(*_schema(spec).names).write.mode("overwrite").parquet(f"{out}/query={query}/batch={batch_id}")

    return (
        latest_in_state(bronze, spec)
        .writeStream.outputMode("update")
        .foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _entries(spark: SparkSession, out: str, spec: TableSpec) -> DataFrame:
    schema = T.StructType([*_schema(spec).fields, T.StructField("query", T.StringType()), T.StructField("batch", T.LongType())])
    return spark.read.schema(schema).parquet(out)


def read_state(spark: SparkSession, out: str, spec: TableSpec) -> DataFrame:
    """The current rows: each key's last entry, without deleted ones.  One row per key and map task is shuffled."""
    if not table_exists(spark, out, schema=_schema(spec)):
        return spark.createDataFrame([], spec.silver_schema)
    last = latest_per_key(_entries(spark, out, spec), spec.key, _STORED)
    return last.filter(~F.coalesce(DELETED, F.lit(False))).select(*spec.silver_schema.names)


def compact_state(spark: SparkSession, out: str, into: str, spec: TableSpec) -> int:
    """Write the last entry of each key, deleted ones too, as the first folder of a new log ``into``; returns the entries dropped.

    The old log stays as it is; readers and the next ``keep_state`` (with its checkpoint as before) go on with the new one.
    """
    entries = _entries(spark, out, spec)
    last = latest_per_key(entries, spec.key, _STORED).select(*_schema(spec).names)
    last.write.parquet(f"{into}/query=compacted/batch=-1")
    return entries.count() - spark.read.schema(_schema(spec)).parquet(f"{into}/query=compacted/batch=-1").count()
