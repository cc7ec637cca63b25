"""Repeated substrings of whole texts, found and cut out: exact, over any number of documents.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else. Such a string holds an anchor, a place chosen
by content (:mod:`tidemark.llm.anchors`), and all its copies hold theirs at the same offset. So occurrences of strings meet by
their anchors' hashes, and only around anchors that occur twice is there anything to find:

* where all occurrences of an anchor have the same surroundings (its context: the bytes that strings over the anchor can reach),
  every string in it is repeated;
* otherwise strings over the anchor are taken by ranges of offsets (bytes of a string before its anchor). All strings of a range
  share a core; contexts with the same core form a group, in which only the bytes around the core are left to compare. A string
  and its copies have one offset, so they meet in a group. Groups go to shards. A shard is one string: the bytes around the cores
  with a mark in each core's place, so that strings are alike only if their cores are. Its suffix array is built by induced
  sorting, its permuted common prefixes tell which strings have a neighbour that shares all of them;
* a group of more than ``MANY`` different surroundings is divided inside its task before it is sorted: its range is halved, its
  cores grow, and the halves are groups of their own.

Texts that are there several times are taken once up to the end: all of such a text goes. Filters of a fixed size keep most
texts and anchors that are not repeated out of the shuffles; whatever they let pass is decided by joins.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.anchors import Hasher, anchors
from tidemark.llm.filters import filtered, key_filter, may_hold
from tidemark.llm.suffixes import permuted_common_prefixes, suffix_array
from tidemark.llm.words import give_back, mix, pieces, text_bytes
from tidemark.session import work_path

LENGTH = 200
#: Bytes hashed for an anchor. A context reaches LENGTH - GRAM bytes before an anchor's first byte and LENGTH from it on.
GRAM = 100
REACH = LENGTH - GRAM
#: Ranges of offsets, and their bounds.
RANGES = 4
_EDGES = [k * (REACH + 1) // RANGES for k in range(RANGES + 1)]
#: Symbols to a suffix array, and different surroundings of one core up to which they are sorted without a division.
SHARD_BYTES, MANY = 1 << 20, 1500
#: Bytes of text that anchors are sought in at a time: some 100 bytes of memory to each.
PIECE = 1 << 20
_SPANS = "array<struct<from:int,to:int>>"


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``id`` (the same, null: -1), ``text`` (null: empty) and two hashes that stand for the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(-1)).alias("id"), text.alias("text"))
    return rows.withColumn("t1", F.xxhash64("text")).withColumn("t2", F.xxhash64(F.lit(1), "text"))


def _anchored(batch: pa.RecordBatch):
    data, offsets = text_bytes(batch.column("text"))
    hasher = Hasher(data)
    return data, offsets, hasher, anchors(hasher, offsets, GRAM, LENGTH)


def _anchor_counts(rows: DataFrame) -> DataFrame:
    """``h`` and ``n``: anchors of each Arrow batch, and how often they occur in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=PIECE):
            _, _, _, found = _anchored(batch)
            h, n = np.unique(found.gram.view(np.int64), return_counts=True)
            yield pa.record_batch({"h": pa.array(h), "n": pa.array(n.astype(np.int64))})
        give_back()

    return rows.select("text").mapInArrow(run, "h long, n long")


def _occurrences(rows: DataFrame, known: Broadcast) -> DataFrame:
    """Every anchor that may be repeated: its place, the bytes before and after it in its context, and the context's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=PIECE):
            _, offsets, hasher, found = _anchored(batch)
            keep = may_hold(known.value, found.gram.view(np.int64))
            at, doc, h = found.at[keep], found.doc[keep], found.gram[keep].view(np.int64)
            low, high = np.maximum(at - REACH, offsets[doc]), np.minimum(at + LENGTH, offsets[doc + 1])
            c = hasher(low, high) ^ ((at - low).astype(np.uint64) << np.uint64(8))
            own = pa.array(doc)
            yield pa.record_batch(
                {
                    "id": batch.column("id").take(own),
                    "t1": batch.column("t1").take(own),
                    "t2": batch.column("t2").take(own),
                    "at": pa.array((at - offsets[doc]).astype(np.int32)),
                    "left": pa.array((at - low).astype(np.int16)),
                    "right": pa.array((high - at).astype(np.int16)),
                    "h": pa.array(h),
                    "c": pa.array(c.view(np.int64)),
                }
            )
        give_back()

    schema = "id long, t1 long, t2 long, at int, left short, right short, h long, c long"
    return rows.select("id", "text", "t1", "t2").mapInArrow(run, schema)


@dataclass
class Around:
    """Rows of groups: what lies around their cores, as places in a buffer of bytes.

    Strings at offsets ``low`` to ``low + width`` reach up to ``width`` bytes to either side of the core; ``before`` and ``after``
    are how many of these there are. ``n``: how often the row occurs.
    """

    group: np.ndarray
    low: np.ndarray
    width: np.ndarray
    left: np.ndarray  # where the bytes before the core end
    right: np.ndarray  # where those after it begin
    before: np.ndarray
    after: np.ndarray
    n: np.ndarray

    def take(self, some: np.ndarray) -> Around:
        return Around(**{f.name: getattr(self, f.name)[some] for f in fields(self)})


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of ranges, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def repeated_offsets(data: np.ndarray, hasher: Hasher, rows: Around) -> tuple[np.ndarray, np.ndarray]:
    """For each row the least and the greatest offset of its repeated strings; none: the greatest is below the least."""
    with np.errstate(over="ignore"):
        key = mix(mix(hasher(rows.left - rows.before, rows.left) ^ rows.group) + hasher(rows.right, rows.right + rows.after))
    _, chosen, own = np.unique(key, return_index=True, return_inverse=True)
    twice = np.bincount(own, np.minimum(rows.n, 2)) > 1
    rows = rows.take(chosen)
    _, code, count = np.unique(rows.group, return_inverse=True, return_counts=True)
    size = count[code]
    least, most = np.full(len(chosen), LENGTH), np.full(len(chosen), -1)
    sort = np.flatnonzero((size > 1) & (size <= MANY))
    sort = sort[np.argsort(code[sort], kind="stable")]
    symbols = np.cumsum(rows.before[sort] + rows.after[sort] + 3)
    ends = np.flatnonzero(np.diff(code[sort], append=-1)) + 1  # of groups
    at = 0
    while at < len(sort):
        limit = np.searchsorted(symbols, (symbols[at - 1] if at else 0) + SHARD_BYTES, "right")
        fits = ends[(ends > at) & (ends <= limit)]
        upto = int(fits[-1]) if len(fits) else int(ends[np.searchsorted(ends, at, "right")])
        some = sort[at:upto]
        least[some], most[some] = _sorted_offsets(data, rows.take(some))
        at = upto
    large = np.flatnonzero(size > MANY)
    for some, half in _halves(hasher, rows, large):
        low, high = repeated_offsets(data, hasher, half)
        least[some], most[some] = np.minimum(least[some], low), np.maximum(most[some], high)
    least[twice] = (rows.low + rows.width - rows.after)[twice]
    most[twice] = (rows.low + rows.before)[twice]
    return least[own], most[own]


def _halves(hasher: Hasher, rows: Around, large: np.ndarray) -> Iterator[tuple[np.ndarray, Around]]:
    """The lower and the upper half of the ranges of groups, and which rows have strings in it. What a half's strings share joins the core."""
    if not len(large):
        return
    middle = rows.width[large] // 2
    for first, last in ((np.zeros_like(middle), middle), (middle + 1, rows.width[large])):
        r, grown = rows.take(large), rows.width[large] - last
        use = np.flatnonzero((first <= last) & (np.maximum(first, r.width - r.after) <= np.minimum(last, r.before)))
        r, first, last, grown = r.take(use), first[use], last[use], grown[use]
        with np.errstate(over="ignore"):
            group = mix(mix(hasher(r.left - first, r.left) ^ r.group) + hasher(r.right, r.right + grown) + first.astype(np.uint64))
        before, after = np.minimum(r.before, last) - first, np.minimum(r.after, r.width - first) - grown
        yield large[use], Around(group, r.low + first, last - first, r.left - first, r.right + grown, before, after, r.n)


def _sorted_offsets(data: np.ndarray, rows: Around) -> tuple[np.ndarray, np.ndarray]:
    """``repeated_offsets`` by one suffix array. A core's mark is two symbols, so that marks do not make as many buckets as cores."""
    size = rows.before + rows.after + 3
    total = int(size.sum()) + 1
    start = np.cumsum(size) - size
    mark = start + rows.before
    code = np.unique(rows.group, return_inverse=True)[1]
    base = math.isqrt(int(code.max())) + 1
    t = np.ones(total, np.int32)  # 1 parts rows, 0 ends the string, bytes follow from 2, marks from 258
    t[_spread(start, rows.before)] = data[_spread(rows.left - rows.before, rows.before)].astype(np.int32) + 2
    t[mark], t[mark + 1] = 258 + code // base, 258 + base + code % base
    t[_spread(mark + 2, rows.after)] = data[_spread(rows.right, rows.after)].astype(np.int32) + 2
    t[-1] = 0
    sa = suffix_array(t, 258 + 2 * base)
    shared = permuted_common_prefixes(t, sa, 3 * int(rows.width.max()) + 6, start)
    whole = np.append(np.repeat(rows.width + 2, size), total)  # a string with its core's mark
    alike = np.zeros(total, bool)
    alike[sa] = shared[sa] >= whole[sa]
    alike[sa[:-1]] |= shared[sa[1:]] >= whole[sa[:-1]]
    # Strings begin at, or before, the mark and must end inside their row. More places than those part two rows.
    count = rows.before + rows.after - rows.width + 1
    place, own = _spread(start, count), np.repeat(np.arange(len(size)), count)
    found = alike[place]
    place, own = place[found], own[found]
    least, most = np.full(len(size), LENGTH), np.full(len(size), -1)
    offset = (rows.low + mark)[own] - place
    most[own[::-1]], least[own] = offset[::-1], offset  # the last one that is set stays
    return least, most


def _in_shards(around: DataFrame, shards: int) -> DataFrame:
    """For contexts with repeated strings, from which byte to which these reach in a range of offsets, counted from the anchor."""

    def run(table: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            key = mix(table["g"].to_numpy().view(np.uint64)) + table["c"].to_numpy().view(np.uint64)
        table = table.take(pa.array(np.unique(key, return_index=True)[1]))  # copies of rows bring copies
        data, offsets = text_bytes(table["outer"])
        low = table["low"].to_numpy().astype(np.int64)
        before = table["before"].to_numpy().astype(np.int64)
        core = offsets[:-1] + before
        rows = Around(
            table["g"].to_numpy().view(np.uint64), low, table["high"].to_numpy() - low, core, core, before, offsets[1:] - core,
            table["n"].to_numpy(),
        )
        least, most = repeated_offsets(data, Hasher(data), rows)
        keep = least <= most
        found = table.select(["h", "c"]).filter(pa.array(keep))
        give_back()
        ends = (("from", -most[keep]), ("to", LENGTH - least[keep]))
        for name, values in ends:
            found = found.append_column(name, pa.array(values.astype(np.int32)))
        return found

    rows = around.withColumn("shard", F.pmod("g", F.lit(shards)))
    return rows.groupBy("shard").applyInArrow(run, "h long, c long, from int, to int")


def _shards(contexts: DataFrame) -> int:
    """Shards for contexts of these sizes (``left`` and ``right``): their bytes but for the anchors, and marks."""
    size = contexts.agg(F.sum(F.col("left") + F.col("right")), F.count("*")).first()
    return max(1, ((size[0] or 0) + (3 * RANGES - GRAM) * size[1]) // SHARD_BYTES)


def _around(picked: DataFrame, rows: DataFrame) -> DataFrame:
    """Contexts by group ``g`` (a range of offsets and a core), with the bytes around the core, of which ``before`` come before it.

    ``picked`` has one occurrence of each context (``id``, ``t1``, ``t2``, ``at``, ``left``, ``right``).
    """
    spots = picked.groupBy("id", "t1", "t2").agg(F.collect_list(F.struct("h", "c", "n", "at", "left", "right")).alias("spots"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            spots = batch.column("spots")
            own = np.repeat(np.arange(batch.num_rows), spots.value_lengths().to_numpy())
            flat = pa.RecordBatch.from_struct_array(spots.flatten())
            data, offsets = text_bytes(batch.column("text"))
            hasher, raw = Hasher(data), data.tobytes()
            at = flat.column("at").to_numpy() + offsets[own]
            left, right = (flat.column(c).to_numpy().astype(np.int64) for c in ("left", "right"))
            for low, end in zip(_EDGES, _EDGES[1:]):
                high = end - 1
                use = np.flatnonzero(np.maximum(low, LENGTH - right) <= np.minimum(high, left))
                core, after = at[use] - low, at[use] + LENGTH - high
                start, stop = at[use] - np.minimum(high, left[use]), at[use] + np.minimum(LENGTH - low, right[use])
                outer = [raw[a:b] + raw[c:d] for a, b, c, d in zip(*(x.tolist() for x in (start, core, after, stop)))]
                group = mix(hasher(core, after) ^ np.uint64(low))
                yield pa.record_batch(
                    {c: flat.column(c).take(pa.array(use)) for c in ("h", "c", "n")}
                    | {
                        "g": pa.array(group.view(np.int64)),
                        "low": pa.array(np.full(len(use), low, np.int16)),
                        "high": pa.array(np.full(len(use), high, np.int16)),
                        "before": pa.array((core - start).astype(np.int16)),
                        "outer": pa.array(outer, pa.binary()),
                    }
                )
        give_back()

    texts = filtered(rows.select("id", "text", "t1", "t2"), "t1", key_filter(picked, "t1"))
    joined = texts.join(spots, ["id", "t1", "t2"]).select("text", "spots")
    return joined.mapInArrow(run, "h long, c long, n long, g long, low short, high short, before short, outer binary")


def _cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[int, list[tuple[int, int]], str]:
    """Bytes removed, in which runs, and the SHA-256 of what is kept."""
    runs: list[list[int]] = []
    for a, b in sorted(spans):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    kept, at = hashlib.sha256(), 0
    for a, b in runs:
        kept.update(data[at:a])
        at = b
    kept.update(data[at:])
    return sum(b - a for a, b in runs), [(a, b) for a, b in runs], kept.hexdigest()


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``removed`` (byte ranges) of every row.

    ``docs``: ``doc_id``, ``text`` (null: empty); other columns are not read. Rows are told apart by their texts alone, so ids may be
    null or repeated. A text shorter than ``LENGTH`` bytes loses nothing.
    """
    spark = docs.sparkSession
    path = work_path(spark, "repeats")
    read = spark.read.parquet
    rows = _keyed(docs)

    _anchor_counts(rows).groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h").write.parquet(f"{path}/anchors")
    repeated = read(f"{path}/anchors")
    found = _occurrences(rows, key_filter(repeated, "h")).join(repeated, "h")
    # Copies of a text are one row from here on; how many there are is kept.
    found = found.groupBy("h", "c", "t1", "t2", "at", "left", "right").agg(
        F.count("*").alias("copies"), F.min("id").alias("id")
    )
    found.write.parquet(f"{path}/found")
    found = read(f"{path}/found")

    mixed = found.groupBy("h").agg((F.min("c") < F.max("c")).alias("mixed")).filter("mixed").select("h")
    spot = F.struct("id", "t1", "t2", "at", "left", "right")
    by_context = found.join(mixed, "h").groupBy("h", "c").agg(F.sum("copies").alias("n"), F.min(spot).alias("spot"))
    by_context.select("h", "c", "n", "spot.*").write.parquet(f"{path}/picked")
    picked = read(f"{path}/picked")
    _in_shards(_around(picked, rows), _shards(picked)).write.parquet(f"{path}/spans")

    single = found.filter("copies = 1")
    # All strings hold the anchor, so what they cover around it is one range, in however many groups they were found.
    spans = read(f"{path}/spans").groupBy("h", "c").agg(F.min("from").alias("from"), F.max("to").alias("to"))
    in_mixed = single.join(spans, ["h", "c"]).select(
        "t1", "t2", (F.col("at") + F.col("from")).alias("from"), (F.col("at") + F.col("to")).alias("to")
    )
    low, high = (F.col("at") - F.col("left")).alias("from"), (F.col("at") + F.col("right")).alias("to")
    alike = single.join(mixed, "h", "left_anti").select("t1", "t2", low, high)
    ranges = in_mixed.unionByName(alike).groupBy("t1", "t2").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    whole = found.filter("copies > 1").select("t1", "t2").distinct()
    changed = ranges.withColumn("whole", F.lit(False)).unionByName(
        whole.select("t1", "t2", F.lit(None).cast(_SPANS).alias("spans"), F.lit(True).alias("whole"))
    )
    changed.write.parquet(f"{path}/changed")
    changed = read(f"{path}/changed")
    known = key_filter(changed, "t1")
    texts = rows.select("doc_id", "text", "t1", "t2")
    hit = filtered(texts, "t1", known).join(changed, ["t1", "t2"], "left").select("doc_id", "text", "spans", "whole")
    rest = texts.withColumn("spans", F.lit(None).cast(_SPANS)).withColumn("whole", F.lit(False)).drop("t2")
    return _without(hit).unionByName(_without(rest, known))


def _without(rows: DataFrame, others: Broadcast | None = None) -> DataFrame:
    """The result for each row; with ``others``, only for rows that this filter certainly does not hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            if others is not None:
                batch = batch.filter(pa.array(~may_hold(others.value, batch.column("t1").to_numpy())))
            data, offsets = text_bytes(batch.column("text"))
            raw = data.tobytes()
            out = []
            columns = (batch.column("spans").to_pylist(), batch.column("whole").to_pylist())
            for i, (spans, whole) in enumerate(zip(*columns)):
                own = raw[offsets[i] : offsets[i + 1]]
                out.append(_cut(own, [(0, len(own))] if whole else [(s["from"], s["to"]) for s in spans or []]))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pa.array(np.diff(offsets)),
                    "n_removed": pa.array([x[0] for x in out], pa.int64()),
                    "n_spans": pa.array([len(x[1]) for x in out], pa.int64()),
                    "kept_sha256": pa.array([x[2] for x in out], pa.string()),
                    "removed": pa.array(
                        [[{"from": a, "to": b} for a, b in x[1]] for x in out],
                        pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])),
                    ),
                }
            )

    schema = f"doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed {_SPANS}"
    return rows.mapInArrow(run, schema)
