"""Connected components of a graph given as a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_path


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node that has a link.

    ``links``: ``a``, ``b`` (comparable, not null). Each round is a stored table, so lineage stays short and a lost executor costs
    one round at most. Neighbours are never gathered: each star is a minimum by key and a join, both safe for hubs. The joins are
    merge joins, so that rounds by the dozen send nothing through the driver.
    """
    path = work_path(spark, "components")
    big, small = F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")
    links.filter("a <> b").select(big, small).distinct().write.parquet(f"{path}/0")
    before, k = None, 0
    while True:
        rows = spark.read.parquet(f"{path}/{k}")
        state = rows.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return rows.select(F.col("x").alias("node"), F.col("y").alias("component")).unionByName(
                rows.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct()
            )
        before = state
        both = rows.unionByName(rows.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("u"), F.least("x", "m").alias("m"))
        large = both.filter("y > x").join(least.hint("merge"), F.col("x") == F.col("u"))
        large.select(F.col("y").alias("x"), F.col("m").alias("y")).write.parquet(f"{path}/{k}-large")
        large = spark.read.parquet(f"{path}/{k}-large")
        least = large.groupBy("x").agg(F.min("y").alias("m")).withColumnRenamed("x", "u")
        star = F.array(F.struct("x", F.col("m").alias("y")), F.struct(F.col("y").alias("x"), F.col("m").alias("y")))
        stars = large.join(least.hint("merge"), F.col("x") == F.col("u")).select(F.inline(star)).filter("x <> y")
        k += 1
        stars.distinct().write.parquet(f"{path}/{k}")
