"""Fixity of archived pages: WARC records, Merkle trees over them, and an audit that descends only where replicas differ.

An archive is a table of records in a fixed order: ``position`` (from 0), ``offset`` (bytes before it), ``page_id`` and the record
itself. A tree hashes each record, then each range of ``FAN_OUT`` positions, then each range of such ranges, up to one root. Two
replicas agree if their roots do. If not, only the children of nodes that differ are compared, level by level, down to records.
Everything but the records is small and built by grouped aggregates of at most ``FAN_OUT`` rows a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FAN_OUT = 64
_PART = 33  # bits of monotonically_increasing_id() below the partition number


def warc_record(url: Column, html: Column, page_id: Column) -> Column:
    """A WARC/1.1 response record as text; null url and html are empty, a null id is 0."""
    body = F.coalesce(html, F.lit(""))
    head = F.format_string(
        "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nWARC-Target-URI: %s\r\n"
        "Content-Type: text/html\r\nContent-Length: %d\r\n\r\n",
        F.coalesce(page_id, F.lit(0)),
        F.coalesce(url, F.lit("")),
        F.octet_length(body),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def write_archive(pages: DataFrame, path: str) -> None:
    """Store ``pages`` (``page_id``, ``url``, ``html``; no other column is read) as records, by page_id (nulls first), then hash.

    Each task of the range sort writes one file; a record's place in it is numbered, and files are added up afterwards by
    :func:`read_archive`, so nothing is ordered in one task. Rows alike get records alike, each at its own position.
    """
    page_id = F.col("page_id").cast("long")
    rows = pages.select(page_id.alias("page_id"), warc_record(F.col("url"), F.col("html"), page_id).alias("record"))
    rows = rows.withColumn("sha256", F.sha2(F.col("record").cast("binary"), 256))
    ordered = rows.repartitionByRange("page_id", "sha256").sortWithinPartitions("page_id", "sha256")
    numbered = ordered.withColumn("row", F.monotonically_increasing_id())
    numbered.select(
        F.shiftright("row", _PART).cast("int").alias("file"),
        F.col("row").bitwiseAND((1 << _PART) - 1).alias("nth"),
        "page_id",
        F.octet_length("record").cast("long").alias("length"),
        F.col("record").cast("binary").alias("record"),
    ).write.option("compression", "zstd").parquet(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records with their ``position`` in the archive."""
    stored = spark.read.parquet(path)
    sizes = stored.groupBy("file").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file, that is per write task, whatever the data's size; this is what is broadcast.
    bases = sizes.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    joined = stored.join(F.broadcast(bases), "file")
    return joined.select((F.col("base") + F.col("nth")).alias("position"), "file", "page_id", "length", "record")


def write_fixity(archive: DataFrame, path: str) -> None:
    """Store ``position``, ``file``, ``page_id``, ``length`` and ``sha256`` of every record.

    Should an archive hold several records at one position, their least and greatest hash and their number are hashed instead.
    """
    one = archive.select("position", "file", "page_id", "length", F.sha2("record", 256).alias("sha256"))
    several = F.sha2(F.concat_ws(" ", F.min("sha256"), F.max("sha256"), F.count("*")).cast("binary"), 256)
    one.groupBy("position").agg(
        F.min("file").alias("file"),
        F.min("page_id").alias("page_id"),
        F.min("length").alias("length"),
        F.when(F.count("*") == 1, F.min("sha256")).otherwise(several).alias("sha256"),
    ).write.parquet(path)


def with_offsets(fixity: DataFrame) -> DataFrame:
    """Adds ``offset``: bytes of all records before. Each file is added up by itself, the files' sums by one small task."""
    files = fixity.groupBy("file").agg(F.sum("length").alias("bytes"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("file", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base"))  # one row per file
    within = Window.partitionBy("file").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    own = fixity.withColumn("before", F.coalesce(F.sum("length").over(within), F.lit(0)))
    return own.join(F.broadcast(bases), "file").withColumn("offset", F.col("base") + F.col("before")).drop("base", "before")


def _parents(nodes: DataFrame) -> DataFrame:
    children = F.array_sort(F.collect_list(F.struct("node", "sha256")))
    joined = F.array_join(F.transform(children, lambda c: c["sha256"]), "")
    return nodes.groupBy(F.floor(F.col("node") / FAN_OUT).alias("node")).agg(F.sha2(joined.cast("binary"), 256).alias("sha256"))


def write_tree(spark: SparkSession, fixity_path: str, path: str) -> int:
    """Store the nodes of each level below ``path`` and return the number of levels; level 0 covers ranges of records.

    An empty archive has one level without nodes.
    """
    below = spark.read.parquet(fixity_path).select(F.col("position").alias("node"), "sha256")
    last = below.agg(F.max("node")).first()[0] or 0
    levels = 0
    while True:
        _parents(below).write.parquet(f"{path}/level={levels}")
        below = spark.read.parquet(f"{path}/level={levels}")
        last //= FAN_OUT
        levels += 1
        if last == 0:
            return levels


def root(spark: SparkSession, tree: str, levels: int) -> str | None:
    """The root hash; null for an empty archive."""
    rows = spark.read.parquet(f"{tree}/level={levels - 1}").select("sha256").take(1)
    return rows[0][0] if rows else None


def _unlike(left: DataFrame, right: DataFrame) -> DataFrame:
    """Nodes that one side lacks or that differ."""
    r = right.select(F.col("node").alias("r_node"), F.col("sha256").alias("r_sha"))
    both = left.join(r, F.col("node") == F.col("r_node"), "full")
    return both.filter(~F.col("sha256").eqNullSafe(F.col("r_sha"))).select(
        F.coalesce("node", "r_node").alias("node"), F.col("sha256").alias("left_sha"), F.col("r_sha").alias("right_sha")
    )


def audit(spark: SparkSession, left: tuple[str, str, int], right: tuple[str, str, int]) -> DataFrame:
    """Positions at which two archives differ, with ``status``: ``changed``, ``missing`` (right lacks it) or ``extra``.

    Each archive is given as its fixity table, tree and levels. A level is read only where the level above differs.
    """
    top = min(left[2], right[2]) - 1

    def level(archive: tuple[str, str, int], k: int) -> DataFrame:
        return spark.read.parquet(f"{archive[1]}/level={k}").select("node", "sha256")

    differ = _unlike(level(left, top), level(right, top))
    for k in range(top - 1, -2, -1):
        parents = differ.select(F.col("node").alias("parent"))

        def below(archive: tuple[str, str, int], k=k, parents=parents) -> DataFrame:
            rows = level(archive, k) if k >= 0 else spark.read.parquet(archive[0]).select(
                F.col("position").alias("node"), "sha256"
            )
            return rows.join(parents, F.floor(F.col("node") / FAN_OUT) == F.col("parent"), "left_semi")

        differ = _unlike(below(left), below(right))
    status = F.when(F.col("right_sha").isNull(), "missing").when(F.col("left_sha").isNull(), "extra").otherwise("changed")
    return differ.select(F.col("node").alias("position"), status.alias("status"))
