"""Bounded samples of labelled rows that classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, held: Column, rows: int, seed: int = 11) -> DataFrame:
    """At most ``rows`` rows of ``docs`` that have a label and are not held out, with ``label`` (0 or 1) and ``part`` (0 to 9).

    Ids are chosen by the least hashes, so that the sample is the same in every run. An id with several labels gets the one
    that most have (1 in a tie), of rows with the same id the least one is taken; null ids and labels are left out. The chosen ids,
    ``rows`` at most, are what is broadcast.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label"))
    known = known.dropna().filter(~held).groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(rows)
    part = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(10)).cast("int")
    own = docs.withColumn("doc_id", F.col("doc_id").cast("long")).drop("label", "part")
    rest = F.struct(*[c for c in own.columns if c != "doc_id"], "label")
    met = own.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(rest).alias("row"))
    return met.select("doc_id", "row.*").withColumn("part", part)
