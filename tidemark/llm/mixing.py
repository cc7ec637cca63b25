"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a share of the mix by weight; no source is repeated more than ``most`` times, and what it cannot take goes
to the others by weight. Whole epochs of a source come first. For the rest of its target each document draws an exponential
key divided by its quality weight; the documents with the smallest keys are taken until their sizes reach the target.

Sorting a source by key and adding up sizes is done in two steps, so that a source of any size is spread over many tasks:
sizes are summed by ranges of keys, the ranges (a bounded number per source) are added up in order, and only the documents of
the one range in which a source's target falls are sorted. Ranges are even on the logarithm of the key, so that whatever its
weights none holds more than a 2,700th of a source. Keys come from hashes, so that reruns and lost executors agree. Texts are never shuffled
but those of that one range.

Defined cases: a null text has no words, null sources are a source, null ids are ids like others; an empty table gives an empty
result, and so does a table without a single word, but for its rows with nothing taken.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import NON_SPACE, cut, give_back, pieces, text_bytes
from tidemark.session import work_path

WEIGHTS = (3.0, 1.0, 2.0)
#: Ranges to each doubling of the key. Whatever the weight w, a key falls into a range around t with probability w t exp(-w t) ln 2 / RANGES.
RANGES = 1 << 10
_LEAST_KEY = 2.0**-60
#: The least quality weight of a document.
LEAST_WEIGHT = 0.05
_LETTER = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
_CAPITAL = np.array([0x41 <= b <= 0x5A for b in range(256)])


def measure(docs: DataFrame, whole: bool = False) -> DataFrame:
    """``doc_id``, ``source``, ``size`` (words of the whole text, null: 0), ``weight`` and ``tie`` (a hash of the text).

    The quality weight is the share of letters among all but white space, lowered by the share of capitals among letters;
    it is 1 for an empty text and at least ``LEAST_WEIGHT``. ``whole`` adds the row itself as the struct ``doc``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(_with_text(b) for b in batches):
            data, offsets = text_bytes(batch.column("text"))
            words = cut(data, offsets, NON_SPACE)

            def count(kind: np.ndarray) -> np.ndarray:
                return np.diff(np.append(0, np.cumsum(kind[data]))[offsets]).astype(np.float64)

            letters, solid = count(_LETTER), count(NON_SPACE)
            weight = letters / np.maximum(solid, 1) * (1 - count(_CAPITAL) / np.maximum(letters, 1))
            weight = np.where(solid > 0, np.maximum(weight, LEAST_WEIGHT), 1.0)
            measured = {"size": pa.array(words.counts, pa.int64()), "weight": pa.array(weight)}
            kept = {name: batch.column(name) for name in ("doc_id", "source", "tie", "doc") if name in batch.schema.names}
            columns = kept | measured
            yield pa.record_batch({name: columns[name] for name in names})
        give_back()

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64("text").alias("tie"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc") if whole else F.col("text"),
    )
    names = ["doc_id", "source", "size", "weight", "tie", *(["doc"] if whole else [])]
    schema = T._parse_datatype_string("doc_id long, source string, size long, weight double, tie long")
    if whole:
        schema = T.StructType([*schema.fields, rows.schema["doc"]])
    return rows.mapInArrow(run, schema)


def _with_text(batch: pa.RecordBatch) -> pa.RecordBatch:
    if "doc" not in batch.schema.names:
        return batch
    doc = batch.column("doc")
    return pa.record_batch({**{n: batch.column(n) for n in batch.schema.names}, "text": doc.field("text")})


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source``, ``source_size``, ``target``: ``share`` of all sizes by weight, at most ``most`` times a source's own size.

    Weights go round over the sources in the order of their code points, null last. One row per source is ordered in one task.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    cap = F.col("source_size") * F.lit(float(most))
    # Fill all sources evenly by weight. Those that are full first come first; the level is reached at the first that is not.
    full_at = Window.orderBy("full", F.col("source").asc_nulls_last())
    earlier = full_at.rowsBetween(Window.unboundedPreceding, -1)
    onward = full_at.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    left = F.sum("source_size").over(all_rows) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    filled = (
        totals.withColumn("w", weight)
        .withColumn("cap", cap)
        .withColumn("full", F.col("cap") / F.col("w"))
        .withColumn("level", left / F.sum("w").over(onward))
        .withColumn("order", F.row_number().over(full_at))
    )
    reached = F.min(F.when(F.col("full") >= F.col("level"), F.struct("order", "level"))).over(all_rows)["level"]
    return filled.withColumn("reached", reached).select(
        "source", "source_size", F.least("cap", F.coalesce(F.col("reached") * F.col("w"), F.col("cap"))).alias("target")
    )


def sampling_key(weight: Column, *seed: Column) -> Column:
    """An exponential variate divided by the weight, from a hash of ``seed``: the smallest keys are a weighted sample."""
    uniform = (F.shiftrightunsigned(F.xxhash64(*seed), 11) + 1) / F.lit(float(1 << 53))
    return -F.log(uniform) / weight


def mix(
    sizes: DataFrame, seed: int = 7, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0, keep: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``sizes`` (as from :func:`measure`, stored) with ``source_size``, ``target``, ``copies``, ``taken`` and what to ``keep``.

    Whole documents are taken; the one at which a source reaches its target is taken if that brings the sum nearer. Equal keys
    are ordered by doc_id, text and size; rows alike in all of these are taken in any order.
    """
    spark = sizes.sparkSession
    key = sampling_key(F.col("weight"), F.lit(seed), F.coalesce("doc_id", F.lit(-1)), F.col("tie"))
    keyed = sizes.withColumn("key", F.greatest(key, F.lit(_LEAST_KEY)))
    keyed = keyed.withColumn("range", F.floor(F.log2("key") * RANGES).cast("int"))

    goal = targets(sizes, weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(0)
    goal = goal.withColumn("epochs", epochs.cast("int"))
    goal = goal.withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size")))

    sums = keyed.groupBy("source", "range").agg(F.sum("size").alias("sum"))
    running = Window.partitionBy("source").orderBy("range")
    sums = sums.withColumn("upto", F.sum("sum").over(running)).withColumnRenamed("source", "s")
    border = (
        sums.join(goal, F.col("s").eqNullSafe(F.col("source")))
        .filter((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("sum") < F.col("rest")))
        .groupBy("source")
        .agg(F.min("range").alias("border"), F.min(F.col("upto") - F.col("sum")).alias("before"))
        .withColumnRenamed("source", "s")
    )
    goal = goal.join(border, F.col("s").eqNullSafe(F.col("source")), "left").drop("s").withColumnRenamed("source", "of")
    # One row per source, stored: Spark knows its size, and sends it to the rows rather than the rows of a source to one task.
    path = work_path(spark, "mix-targets")
    goal.write.parquet(path)
    rows = keyed.join(spark.read.parquet(path), F.col("source").eqNullSafe(F.col("of"))).drop("of")

    inside = rows.filter(F.coalesce(F.col("range") != F.col("border"), F.lit(True)))
    inside = inside.withColumn("chosen", F.coalesce(F.col("range") < F.col("border"), F.lit(False)))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "tie", "size")
    after = F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at_border = rows.filter(F.col("range") == F.col("border")).withColumn("after", after)
    nearer = F.col("after") + (F.col("after") - F.col("size")) <= 2 * F.col("rest")
    at_border = at_border.withColumn("chosen", nearer).drop("after")

    copies = F.col("epochs") + F.col("chosen").cast("int")
    taken = (copies * F.col("size")).alias("taken")
    return inside.unionByName(at_border).select(
        "doc_id", "source", "size", "tie", "source_size", "target", copies.alias("copies"), taken, *keep
    )


def mixed_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The rows of ``docs``, with all their columns, each as often as the mix takes it; repeated rows and ids count one by one."""
    spark = docs.sparkSession
    path = f"{work_path(spark, 'mix')}/sizes"
    measure(docs, whole=True).write.parquet(path)
    taken = mix(spark.read.parquet(path), seed, keep=["doc"]).filter("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
