"""Filters of a fixed size over keys, that keep rows which certainly do not match out of a shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter: 8 MB, whatever the data's size. With more keys it lets more through and stays right.
BITS = 1 << 26


def key_filter(keys: DataFrame, column: str) -> Broadcast:
    """A filter of ``BITS`` bits over a column of 64-bit hashes. What is gathered and broadcast has this size at most."""
    bit = F.pmod(F.col(column), F.lit(BITS))
    words = keys.select(
        F.shiftright(bit, 5).cast("int").alias("word"), F.expr(f"shiftleft(1L, int(pmod({column}, 32)))").alias("bit")
    )
    found = words.groupBy("word").agg(F.bit_or("bit").cast("long").alias("bits")).toArrow()
    table = np.zeros(BITS // 32, np.uint32)
    table[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return keys.sparkSession.sparkContext.broadcast(table)


def may_hold(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = np.mod(keys, 32 * len(table))
    return (table[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1


def filtered(rows: DataFrame, column: str, known: Broadcast, hit: bool = True) -> DataFrame:
    """Rows whose key in ``column`` may be (or, without ``hit``, cannot be) one of the filter's; keys are not null."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(column)
        for batch in batches:
            yield batch.filter(pa.array(may_hold(known.value, batch.column(at).to_numpy()) == hit))

    return rows.mapInArrow(run, rows.schema)


def unlisted(rows: DataFrame, column: str, listed: DataFrame) -> DataFrame:
    """Rows whose key in ``column`` (a 64-bit hash, not null) is not in the column of that name of ``listed``.

    Only rows that may be listed are shuffled; all others pass where they are.
    """
    known = key_filter(listed, column)
    maybe = filtered(rows, column, known).join(listed.select(column).distinct(), column, "left_anti")
    return filtered(rows, column, known, hit=False).unionByName(maybe)
