"""Stored tables: reading, existence, and logical names bound to paths."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The error conditions by which Spark says that nothing has been written at a path yet.
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND", "DELTA_PATH_DOES_NOT_EXIST")


def read_table(
    spark: SparkSession, path: str, *, fmt: str = "parquet", schema: StructType | str | None = None
) -> DataFrame:
    """Batch scan of a stored table."""
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    return reader.load(path)


def table_exists(
    spark: SparkSession, path: str, *, fmt: str = "parquet", schema: StructType | str | None = None
) -> bool:
    """Whether something has been written at ``path``; any error other than "nothing there" is raised.

    A known ``schema`` spares Spark the job that would infer it.
    """
    try:
        read_table(spark, path, fmt=fmt, schema=schema)
    except AnalysisException as error:
        if error.getCondition() in _ABSENT:
            return False
        raise
    return True


@dataclass(frozen=True)
class SourceBinding:
    """Logical table names and the path template they resolve to, e.g. ``s3a://silver/{name}``.

    ``opener`` reads a table that is not plain files, given its name and path.
    """

    location: str
    names: tuple[str, ...]
    fmt: str = "parquet"
    opener: Callable[[SparkSession, str, str], DataFrame] | None = None

    def path(self, name: str) -> str:
        if name not in self.names:
            raise KeyError(f"{name} is not a declared source")
        return self.location.format(name=name)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        if self.opener:
            return self.opener(spark, name, self.path(name))
        return read_table(spark, self.path(name), fmt=self.fmt)

    def openers(self, spark: SparkSession) -> dict[str, Callable[[], DataFrame]]:
        """For each name how it is opened, as models resolve it."""
        return {name: partial(self.read, spark, name) for name in self.names}

    def register(self, spark: SparkSession, only: Iterable[str] | None = None) -> None:
        """Expose the sources to SQL as temporary views."""
        for name in only or self.names:
            self.read(spark, name).createOrReplaceTempView(name)
