"""Sharding by sampled splitters: shards of nearly equal bytes, cut from one order of all records.

The order is (key, doc_id, row); the key is a hash of the text, so that equal texts stand together and share a shard unless a
border falls among them. A shard is the records whose middle byte falls into its part of the sum of all sizes, which fixes the
result whatever was sampled. Samples only divide the work: a bounded sample, drawn with weights by size, is sorted and cut at its
quantiles, and records are partitioned by these splitters. Splitters hold all three parts of the order, so a text with very many
copies is divided by doc_id. Ranges that still hold more than twice their share are sampled and
cut again. Running sums are then
taken inside ranges, and over the ranges' totals for what lies before. DataFrame functions only.

Defined cases: a null text is one of no bytes; null ids come first among equal texts; rows alike in all returned columns
may change places; an empty table gives an empty result; columns other than ``doc_id`` and ``text`` are never read by the
assignment, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import work_path

#: Ranges aimed at, sampled records for each, and how often overfull ranges are cut again.
RANGES, PER_RANGE, ROUNDS = 256, 32, 3
#: Ranges of fewer records are left as they are: cutting them would spread no work.
FEW = 1000
#: Bytes that a record takes beside its text.
OVERHEAD = 8
_ORDER = ("key", "id", "row")
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1

Splitter = tuple[int, int, int]


def measure(docs: DataFrame, path: str, whole: bool = False) -> None:
    """Store ``row`` (a number of its own), ``doc_id``, ``size``, ``text_crc32`` and the order's ``key`` and ``id`` of each record.

    ``whole`` keeps the record as well, in a struct ``doc``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    columns = [
        doc_id.alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long").alias("key"),
        F.coalesce(doc_id, F.lit(_LEAST)).alias("id"),
    ]
    if whole:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    docs.select(*columns).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)


def _numbers(values: Iterable[int]) -> Column:
    """A constant array of whole numbers; as text it is one node of the plan, however many there are."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def with_range(rows: DataFrame, splitters: list[Splitter]) -> DataFrame:
    """``rows`` with ``range``: how many of the sorted ``splitters`` are not after the row. A binary search, one step a projection."""
    depth = len(splitters).bit_length()
    padded = [*splitters, *[(_MOST, _MOST, _MOST)] * ((1 << depth) - 1 - len(splitters))]
    parts = [_numbers(s[i] for s in padded) for i in range(3)]
    rows = rows.withColumn("range", F.lit(0))
    for level in reversed(range(depth)):
        at = F.col("range") + ((1 << level) - 1)
        key, doc, row = (F.get(p, at) for p in parts)
        reached = (key < F.col("key")) | ((key == F.col("key")) & ((doc < F.col("id")) | ((doc == F.col("id")) & (row <= F.col("row")))))
        rows = rows.withColumn("range", F.col("range") + F.when(reached, 1 << level).otherwise(0))
    return rows


def _sample(rows: DataFrame, wanted: Column, weight: int, size: int, seed: int) -> list[tuple[int, Splitter]]:
    """About ``size`` of the wanted rows, ``weight`` bytes in all, as (range, place in the order), sorted.

    Each draws an exponential variate over its size; those below a bar that about twice ``size`` fall short of are sent, and the
    least are taken, so that no task sends more than its share.
    """
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "key", "id", "row"), 11) + 1) / F.lit(float(1 << 53))
    # Unpacked by a generator: a filter would be pushed through the steps of the search, each of which names the one before it five times.
    drawn = rows.select(F.explode(F.array(F.struct("range", *_ORDER, (-F.log(uniform) / F.col("size")).alias("drawn")))).alias("r")).select("r.*")
    chosen = drawn.filter(wanted & (F.col("drawn") <= 2 * size / max(1, weight))).orderBy("drawn").limit(size)
    return sorted((r["range"], (r["key"], r["id"], r["row"])) for r in chosen.collect())


def _quantiles(sample: list[Splitter], parts: int) -> list[Splitter]:
    return sorted({sample[len(sample) * i // parts] for i in range(1, parts)} if sample else set())


def splitters(rows: DataFrame, ranges: int = RANGES, seed: int = 5) -> tuple[list[Splitter], list[tuple[int, int]]]:
    """Splitters, sorted, and each range's bytes and records. What reaches the driver is bounded by ``ranges``, not by the rows."""
    size = ranges * PER_RANGE
    weight = rows.agg(F.sum("size")).first()[0] or 0
    found = _quantiles([place for _, place in _sample(with_range(rows, []), F.lit(True), weight, size, seed)], ranges)
    for again in range(ROUNDS + 1):
        split = with_range(rows, found)
        sums = {r["range"]: (r["bytes"], r["n"]) for r in split.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()}
        totals = [sums.get(i, (0, 0)) for i in range(len(found) + 1)]
        share = [max(1, sum(t[i] for t in totals) // ranges) for i in range(2)]
        # How many shares an overfull range holds, by bytes or by records.
        over = {i: max(b // share[0], n // share[1]) for i, (b, n) in enumerate(totals) if n > FEW and (b > 2 * share[0] or n > 2 * share[1])}
        if not over or again == ROUNDS:
            break
        sample = _sample(split, F.col("range").isin(list(over)), sum(totals[i][0] for i in over), size, seed + again + 1)
        more = {s for i, parts in over.items() for s in _quantiles([place for r, place in sample if r == i], parts + 1)}
        if not more - set(found):
            break
        found = sorted(more | set(found))
    return found, totals


def assign(spark: SparkSession, path: str, shards: int, ranges: int = RANGES) -> DataFrame:
    """``row, doc_id, size, text_crc32, shard, slot`` of every record that :func:`measure` stored at ``path``.

    Shards count from 0 and differ by less than the largest record from equal bytes; slots are gapless from 0 in each shard.
    """
    rows = spark.read.parquet(path).select("row", "doc_id", "size", "text_crc32", "key", "id")
    cuts, totals = splitters(rows, ranges)
    before, all_bytes, all_rows = [], 0, 0
    for size, n in totals:
        before.append((all_bytes, all_rows))
        all_bytes, all_rows = all_bytes + size, all_rows + n
    bases = [F.get(_numbers(b[i] for b in before), F.col("range")) for i in range(2)]
    upto = Window.partitionBy("range").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    number = Window.partitionBy("range").orderBy(*_ORDER)
    placed = (
        with_range(rows, cuts)
        .withColumn("end", bases[0] + F.sum("size").over(upto))
        .withColumn("place", bases[1] + F.row_number().over(number) - 1)
    )
    # The part in which the middle of the record lies.
    shard = F.expr(f"least({shards - 1}, ((2 * end - size) * {shards}) div {max(1, 2 * all_bytes)})").cast("int")
    out = f"{work_path(spark, 'shards')}/placed"
    placed.select("row", "doc_id", "size", "text_crc32", "place", shard.alias("shard")).write.parquet(out)
    stored = spark.read.parquet(out)
    firsts = {r["shard"]: r["first"] for r in stored.groupBy("shard").agg(F.min("place").alias("first")).collect()}
    first = F.get(_numbers(firsts.get(s, 0) for s in range(shards)), F.col("shard"))
    return stored.select("row", "doc_id", "size", "text_crc32", "shard", (F.col("place") - first).alias("slot"))


def shard_digest(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every record; the law is ``bytes``."""
    spark = docs.sparkSession
    path = f"{work_path(spark, 'shards')}/measured"
    measure(docs, path)
    return assign(spark, path, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(docs: DataFrame, out: str, shards: int = 24, files: int = 1) -> None:
    """Store the records, with all their columns in the struct ``doc``, below ``out`` by ``shard``, each shard in ``files`` files by ``slot``."""
    spark = docs.sparkSession
    path = f"{work_path(spark, 'shards')}/measured"
    measure(docs, path, whole=True)
    placed = assign(spark, path, shards)
    part = placed.groupBy("shard").agg(F.count("*").alias("n")).withColumnRenamed("shard", "of")
    placed = placed.join(F.broadcast(part), F.col("shard") == F.col("of")).drop("of")
    placed = placed.withColumn("file", F.expr(f"(slot * {files}) div n").cast("int")).select("row", "shard", "slot", "file")
    records = spark.read.parquet(path).select("row", "doc").join(placed, "row")
    ordered = records.repartitionByRange(max(1, shards * files), "shard", "file").sortWithinPartitions("shard", "slot")
    ordered.select("shard", "slot", "doc").write.partitionBy("shard").parquet(out)
