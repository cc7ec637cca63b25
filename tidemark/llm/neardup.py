"""Near-duplicate documents by SetSketch: registers, bands, a joint likelihood estimate, then full sets.

A document's set of word shingles is summarised in registers, each the truncated logarithm of the smallest of exponential
variates drawn for the set's members (see Ertl, "SetSketch: filling the gap between MinHash and HyperLogLog"). Registers of a
union are the maxima of the parts' registers, and equal registers are likelier the more two sets have in common, so bands of
registers serve as buckets. With 40 bands of 6 registers a pair at similarity 0.85 shares 15 buckets on average, none with
probability 6e-9.

Documents with equal sets are one class first, so that copies cost one row each. Then links are found in three rounds: every
class against the pivot of its largest bucket; where a bucket then holds several components, its members against its pivot if
their components differ; where it still does, its other pairs of different components. Those are never rows: a task holds a
bucket's members. Of small buckets it holds their registers and reports the pairs whose sizes allow the similarity asked for and whose
estimate comes near it. Of large ones it holds two chunks of full sets, cut by members and by bytes, and reports only links it has
confirmed. Every link is confirmed on the full sets. Nothing is capped.

Defined cases: null texts and texts without words are linked with nothing and stay; null and repeated ids, repeated rows and extra columns
of any name and type are the functions' own to say; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.filters import filtered, key_filter, unlisted
from tidemark.llm.words import NON_SPACE, cut, give_back, lower_ascii, mix, pieces, text_bytes
from tidemark.session import work_path

SHINGLE = 3
SIMILAR = (85, 100)
BANDS, ROWS = 40, 6
REGISTERS = BANDS * ROWS
BASE, RATE, LIMIT = 1.01, 20.0, 4096
#: Estimates this far below the threshold are left out: six standard errors.
MARGIN = 0.15
#: Members of a bucket up to which registers come before full sets; members, and bytes of full sets, to a chunk of a larger one.
SMALL, CHUNK, CHUNK_BYTES = 64, 2048, 16 << 20
#: Pairs whose registers are compared at a time, and bytes of text that sets are made of at a time.
PAIRS, PIECE = 1 << 13, 1 << 20
_SEEDS = [np.uint64(x) for x in (0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each whole text, ascending, one text after the other, and where each text's begin.

    A text of fewer words than a shingle is one shingle; a text without words has none.
    """
    data, offsets = text_bytes(texts)
    words = cut(lower_ascii(data), offsets, NON_SPACE)
    hashes, counts = words.hashes(), words.counts
    with np.errstate(over="ignore"):
        full = np.maximum(counts - size + 1, 0)
        doc = np.repeat(np.arange(len(counts)), full)
        at = np.repeat(words.first[:-1] - (np.cumsum(full) - full), full) + np.arange(full.sum())
        whole = np.zeros(len(at), np.uint64)
        for i in range(size):
            whole = mix(whole * _SEEDS[0] + hashes[at + i] + _SEEDS[1])
        few = np.flatnonzero((counts > 0) & (counts < size))
        short = np.zeros(len(few), np.uint64)
        for i in range(size - 1):
            more = counts[few] > i
            short[more] = mix(short[more] * _SEEDS[0] + hashes[words.first[few[more]] + i] + _SEEDS[1])
        short = mix(short ^ counts[few].astype(np.uint64))
    doc, whole = np.append(doc, few), np.append(whole, short)
    order = np.lexsort((whole, doc))
    doc, whole = doc[order], whole[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (whole[1:] != whole[:-1])
    doc, whole = doc[new], whole[new]
    return whole, np.searchsorted(doc, np.arange(len(counts) + 1))


def prints(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of each set."""
    with np.errstate(over="ignore"):
        found = []
        for seed in _SEEDS[2:]:
            total = np.append(np.uint64(0), np.cumsum(mix(hashes * seed + seed), dtype=np.uint64))
            found.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
    return found[0], found[1]


def registers(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SetSketch registers of each set (a row each); an empty set has zeros.

    A member draws the points of a Poisson process and deals each to a register; it stops as soon as its next point is beyond
    the largest value that any register of its set still has, as no later point can count.
    """
    n = len(first) - 1
    least = np.full((n, REGISTERS), np.inf)
    flat = least.reshape(-1)
    doc = np.repeat(np.arange(n), np.diff(first))
    member, point, drawn = hashes, np.zeros(len(hashes)), np.zeros(len(hashes), np.uint64)
    with np.errstate(over="ignore"):
        while len(member):
            draws = int(np.clip(200_000 // len(member), 1, 256))
            number = drawn[:, None] + np.arange(1, draws + 1, dtype=np.uint64)
            bits = mix(member[:, None] + number * _SEEDS[0])
            gaps = -np.log(((bits >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / (REGISTERS * RATE)
            points = point[:, None] + np.cumsum(gaps, axis=1)
            target = (mix(bits ^ _SEEDS[1]) % np.uint64(REGISTERS)).astype(np.int64)
            np.minimum.at(flat, (doc[:, None] * REGISTERS + target).reshape(-1), points.reshape(-1))
            open_ = points[:, -1] < least.max(axis=1)[doc]
            member, doc, point = member[open_], doc[open_], points[open_, -1]
            drawn = drawn[open_] + np.uint64(draws)
    with np.errstate(divide="ignore", invalid="ignore"):
        value = np.floor(1 - np.log(least) / np.log(BASE))
    return np.clip(np.nan_to_num(value, neginf=0), 0, LIMIT).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """A 64-bit bucket key for each band of each row of registers."""
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * _SEEDS[2], (len(regs), BANDS)).copy()
        bands = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
        for i in range(ROWS):
            key = mix(key * _SEEDS[0] + bands[:, :, i] + _SEEDS[3])
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, steps: int = 101) -> np.ndarray:
    """Jaccard similarity of pairs by maximum likelihood, from how often the first, the second or neither register is greater."""
    above, below = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - above - below
    u = (n_a / np.maximum(n_a + n_b, 1))[:, None]
    v = 1 - u
    most = np.minimum(u, v) / np.maximum(np.maximum(u, v), 1e-12)
    j = np.linspace(0, 1, steps)[None, :] * most

    def share(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    first, second = share(u - v * j), share(v - u * j)
    with np.errstate(divide="ignore"):
        logs = [np.log(np.maximum(x, 1e-12)) for x in (first, second, 1 - first - second)]
    likelihood = above[:, None] * logs[0] + below[:, None] * logs[1] + equal[:, None] * logs[2]
    return np.take_along_axis(j, likelihood.argmax(1)[:, None], 1)[:, 0]


def similar(common: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, alike: tuple[int, int]) -> np.ndarray:
    part, whole = alike
    return whole * common >= part * (n_a + n_b - common)


def likely(regs_a: np.ndarray, regs_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, alike: tuple[int, int]) -> np.ndarray:
    """Which pairs' sizes allow the similarity asked for and whose estimate comes near it."""
    part, whole = alike
    near = np.minimum(n_a, n_b) * whole >= np.maximum(n_a, n_b) * part
    at = np.flatnonzero(near)
    for a in range(0, len(at), PAIRS):
        i = at[a : a + PAIRS]
        near[i] = estimate(regs_a[i], regs_b[i], n_a[i], n_b[i]) >= part / whole - MARGIN
    return near


def _sketches(rows: DataFrame, size: int) -> DataFrame:
    """``n``, fingerprints and bucket keys of every row's text, beside the row's other columns."""
    ids = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=PIECE):
            hashes, first = shingle_sets(batch.column("text"), size)
            one, two = prints(hashes, first)
            keys = band_keys(registers(hashes, first))
            n = np.diff(first)
            bounds = np.append(0, np.cumsum(np.where(n > 0, BANDS, 0))).astype(np.int32)
            yield pa.record_batch(
                {
                    **{c: batch.column(c) for c in ids},
                    "n": pa.array(n, pa.int64()),
                    "f1": pa.array(one),
                    "f2": pa.array(two),
                    "keys": pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys[n > 0].reshape(-1))),
                }
            )
        give_back()

    return rows.mapInArrow(run, f"{', '.join(f'{c} long' for c in ids)}, n long, f1 long, f2 long, keys array<long>")


def _full_sets(rows: DataFrame, size: int) -> DataFrame:
    """``id``, fingerprints, ``n``, ``members`` and ``regs`` of rows (``id``, ``text``) whose set has the fingerprints asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=PIECE):
            hashes, first = shingle_sets(batch.column("text"), size)
            one, two = prints(hashes, first)
            regs = registers(hashes, first)
            keep = (one == batch.column("f1").to_numpy()) & (two == batch.column("f2").to_numpy())
            at = np.flatnonzero(keep)
            yield pa.record_batch(
                {
                    "id": batch.column("id").take(pa.array(at)),
                    "f1": pa.array(one[at]),
                    "f2": pa.array(two[at]),
                    "n": pa.array(np.diff(first)[at], pa.int64()),
                    "members": pa.array([hashes[first[i] : first[i + 1]].tobytes() for i in at], pa.binary()),
                    "regs": pa.array([regs[i].tobytes() for i in at], pa.binary()),
                }
            )
        give_back()

    return rows.select("id", "text", "f1", "f2").mapInArrow(run, "id long, f1 long, f2 long, n long, members binary, regs binary")


def _registers_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def _side(sets: DataFrame, side: str, *columns: str) -> DataFrame:
    return sets.select(F.col("id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns))


def _confirmed(pairs: DataFrame, sets: DataFrame, alike: tuple[int, int]) -> DataFrame:
    """Of pairs (``a``, ``b``) those that are similar: first by the estimate of their registers, then on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sizes = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
                near = likely(*[_registers_of(batch.column(c)) for c in ("regs_a", "regs_b")], *sizes, alike)
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(near)) for c in ("a", "b")], ["a", "b"])
        give_back()

    both = pairs.join(_side(sets, "a", "n", "regs"), "a").join(_side(sets, "b", "n", "regs"), "b")
    return _exact(both.mapInArrow(run, "a long, b long"), sets, alike)


def _exact(pairs: DataFrame, sets: DataFrame, alike: tuple[int, int]) -> DataFrame:
    """Of pairs (``a``, ``b``) those whose full sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("members_a"), batch.column("members_b")):
                x, y = (np.frombuffer(m.as_buffer(), np.uint64) for m in (x, y))
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                keep.append(bool(similar(np.count_nonzero(y[at] == x), len(x), len(y), alike)))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], ["a", "b"])
        give_back()

    return pairs.join(_side(sets, "a", "members"), "a").join(_side(sets, "b", "members"), "b").mapInArrow(run, "a long, b long")


def _likely_in_buckets(rows: DataFrame, sets: DataFrame, alike: tuple[int, int]) -> DataFrame:
    """Pairs (``a`` < ``b``) of members of one bucket, of different components, that are likely similar.

    ``rows``: ``key``, ``id``, ``component`` of buckets of at most ``SMALL`` members. A bucket's members come to one task one after
    the other, each with its registers; pairs are made there, an offset at a time for all buckets of a batch.
    """

    def pairs_of(rows: pa.Table) -> pa.RecordBatch:
        key, ids, comps, n = (rows[c].to_numpy() for c in ("key", "id", "component", "n"))
        regs = _registers_of(rows["regs"])
        found = [np.zeros((0, 2), np.int64)]
        for step in range(1, len(key)):
            same = np.flatnonzero(key[step:] == key[:-step])
            if not len(same):
                break
            same = same[comps[same] != comps[same + step]]
            if len(same):
                same = same[likely(regs[same], regs[same + step], n[same], n[same + step], alike)]
                found.append(np.sort(np.column_stack([ids[same], ids[same + step]]), axis=1))
        both = np.unique(np.concatenate(found), axis=0)
        return pa.record_batch({"a": pa.array(both[:, 0]), "b": pa.array(both[:, 1])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            key = held["key"].to_numpy()
            whole = int(np.searchsorted(key, key[-1]))  # the last bucket may go on in the next batch
            if whole:
                yield pairs_of(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None:
            yield pairs_of(held)
        give_back()

    members = rows.select("key", "id", "component").join(sets.select("id", "n", "regs"), "id").repartition("key")
    ordered = members.sortWithinPartitions("key", "id").select("key", "id", "component", "n", "regs")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def _links_in_chunks(batch: pa.Table, alike: tuple[int, int]) -> Iterator[tuple[int, int]]:
    """Links between members of different components in one task's share of a bucket; one per pair of components at most."""
    ids, comps = batch["id"].to_numpy(), batch["component"].to_numpy()
    sides = batch["side"].to_numpy()
    sets = [np.frombuffer(m.as_buffer(), np.uint64) for m in batch["members"]]
    sizes = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    value, code = np.unique(every, return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    by_value = np.argsort(code, kind="stable")
    ends = np.append(0, np.cumsum(np.bincount(code, minlength=len(value))))
    first = np.cumsum(sizes) - sizes
    root = {c: c for c in np.unique(comps).tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    kinds, counts = np.unique(comps, return_counts=True)
    largest = kinds[counts.argmax()]
    for i in np.flatnonzero(comps != largest):
        own = code[first[i] : first[i] + sizes[i]]
        spans = [by_value[ends[c] : ends[c + 1]] for c in own.tolist()]
        common = np.bincount(owner[np.concatenate(spans)], minlength=len(sets))
        near = similar(common, sizes[i], sizes, alike) & (comps != comps[i])
        if sides[i] in (0, 1):  # the two chunks of a task are compared with each other only
            near &= sides != sides[i]
        for k in np.flatnonzero(near):
            a, b = find(int(comps[i])), find(int(comps[k]))
            if a != b:
                root[a] = b
                yield int(ids[i]), int(ids[k])


def _large_buckets(rows: DataFrame, sets: DataFrame, alike: tuple[int, int]) -> DataFrame:
    """Links between different components of buckets with more than ``SMALL`` members.

    ``rows``: ``key``, ``id``, ``component``, ``n``. A bucket is dealt into chunks of about ``CHUNK`` members or ``CHUNK_BYTES`` of full
    sets, whichever are more, and every two chunks (or one by itself) meet in a task.
    """
    chunks = F.greatest(F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("n") * 8 / CHUNK_BYTES)).cast("int")
    rows = rows.join(rows.groupBy("key").agg(chunks.alias("chunks")).hint("merge"), "key")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    low, high = F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    rows = rows.select("key", low, high, side.alias("side"), "id", "component").join(sets.select("id", "members"), "id")
    # A chunk meets itself alone (side 2); its copies for other chunks go to tasks of their own (sides 0 and 1).
    group = F.when(F.col("low") == F.col("high"), F.concat_ws(":", "key", "low")).otherwise(F.concat_ws(":", "key", "low", "high"))

    def run(table: pa.Table) -> pa.Table:
        found = list(_links_in_chunks(table, alike))
        give_back()
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return rows.withColumn("group", group).groupBy("group").applyInArrow(run, "a long, b long")


def _linked(
    rows: DataFrame,
    key: list[str],
    leaders: DataFrame,
    keyed: DataFrame,
    again: bool,
    path: str,
    size: int,
    alike: tuple[int, int],
    tied: DataFrame | None = None,
) -> DataFrame:
    """``node`` and ``component`` of classes of equal sets that are linked with others.

    ``keyed`` has each class (``id``) with the size ``n`` of its set and its bucket keys once, ``leaders`` where its text is: in the rows with this ``key`` and
    these fingerprints, more than one of them if ``again``. ``tied`` are links known beforehand.
    """
    spark = rows.sparkSession
    read = spark.read.parquet

    # Buckets with at least two classes.
    slots = keyed.select("id", "n", F.explode("keys").alias("key"))
    pivot = F.min(F.struct(F.xxhash64("id").alias("order"), "id"))["id"]
    shared = slots.groupBy("key").agg(F.count("*").alias("size"), pivot.alias("pivot")).filter("size > 1")
    slots.join(shared, "key").write.parquet(f"{path}/buckets")
    buckets = read(f"{path}/buckets")

    wanted = buckets.select("id").distinct().join(leaders, "id")
    _full_sets(rows.join(wanted, key), size).write.parquet(f"{path}/sets")
    sets = read(f"{path}/sets")
    if again:
        sets = sets.groupBy("id", "f1", "f2", "n").agg(F.first("members").alias("members"), F.first("regs").alias("regs"))

    # First round: every class and the pivot of its largest bucket.
    largest = F.max_by("pivot", F.struct("size", "key")).alias("b")
    buckets.filter("id <> pivot").groupBy(F.col("id").alias("a")).agg(largest).write.parquet(f"{path}/pairs-1")
    _confirmed(read(f"{path}/pairs-1"), sets, alike).write.parquet(f"{path}/links-1")
    links = read(f"{path}/links-1") if tied is None else read(f"{path}/links-1").unionByName(tied)
    components(spark, links).write.parquet(f"{path}/components-1")

    # Second round: in buckets that hold several components, members of another one than their pivot's.
    placed = _mixed(buckets, read(f"{path}/components-1"))
    pairs = placed.filter("component <> pivot_component").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    pairs = pairs.join(read(f"{path}/pairs-1"), ["a", "b"], "left_anti")
    _confirmed(pairs, sets, alike).write.parquet(f"{path}/links-2")
    components(spark, _and_links(read(f"{path}/components-1"), read(f"{path}/links-2"))).write.parquet(f"{path}/components-2")

    # Third round: all other pairs of different components.
    _mixed(buckets.filter("size > 2"), read(f"{path}/components-2")).write.parquet(f"{path}/open")
    open_rows = read(f"{path}/open")
    few = open_rows.filter(F.col("members") <= SMALL).filter("id <> pivot")
    _likely_in_buckets(few, sets, alike).write.parquet(f"{path}/pairs-3")
    many = open_rows.filter(F.col("members") > SMALL).select("key", "id", "component", "n")
    links = _exact(read(f"{path}/pairs-3"), sets, alike).unionByName(_large_buckets(many, sets, alike))
    links.write.parquet(f"{path}/links-3")
    components(spark, _and_links(read(f"{path}/components-2"), read(f"{path}/links-3"))).write.parquet(f"{path}/components-3")
    return read(f"{path}/components-3")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, alike: tuple[int, int] = SIMILAR) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (the smallest doc_id reachable over links) and ``kept`` of every row.

    ``docs``: ``doc_id``, ``text``; other columns are not read. Texts without words, null ones too, are linked with nothing. Rows
    with the same doc_id are one node, with the links of all their texts. Rows without an id take no part: their component is
    null and they are kept.
    """
    spark = docs.sparkSession
    path = work_path(spark, "near-duplicates")
    read = spark.read.parquet

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    _sketches(rows, size).write.parquet(f"{path}/sketches")
    sketches = read(f"{path}/sketches")
    sound = sketches.filter("n > 0 AND doc_id IS NOT NULL")
    classes = sound.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("id"))
    sound.select("doc_id", "f1", "f2", "n").join(classes, ["f1", "f2", "n"]).select("doc_id", "id", "f1", "f2").distinct().write.parquet(
        f"{path}/classes"
    )
    members = read(f"{path}/classes")
    leaders = members.filter("doc_id = id").select("id", "f1", "f2")

    keyed = sound.select(F.col("doc_id").alias("id"), "f1", "f2", "n", "keys").join(leaders, ["id", "f1", "f2"], "left_semi")
    again = _repeats(sound)
    if again:
        keyed = keyed.groupBy("id", "f1", "f2", "n").agg(F.first("keys").alias("keys"))
    # Ids with several texts link their classes.
    several = members.groupBy("doc_id").agg(F.min("id").alias("b"), F.max("id").alias("c")).filter("b < c")
    same_id = members.join(several, "doc_id").select(F.col("id").alias("a"), "b")

    last = _linked(rows, ["doc_id"], leaders.withColumn("doc_id", F.col("id")), keyed, again, path, size, alike, same_id)
    last = last.select(F.col("node").alias("id"), "component")
    own = members.select("doc_id", "id").groupBy("doc_id").agg(F.min("id").alias("id"))
    placed = own.join(last, "id", "left").select(
        F.col("doc_id").alias("of"), F.coalesce("component", "id").alias("component")
    )
    rows = sketches.select("doc_id", F.col("n").alias("n_shingles")).join(placed, F.col("doc_id") == F.col("of"), "left")
    component = F.coalesce("component", "doc_id")
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _mixed(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of buckets that hold several components, with ``component``, ``pivot_component`` and the bucket's ``members``."""
    rows = buckets.join(found.withColumnRenamed("node", "id"), "id", "left")
    rows = rows.withColumn("component", F.coalesce("component", "id"))
    stats = rows.groupBy("key").agg(
        F.max(F.when(F.col("id") == F.col("pivot"), F.col("component"))).alias("pivot_component"),
        F.count("*").alias("members"),
        (F.min("component") < F.max("component")).alias("mixed"),
    )
    return rows.join(stats.filter("mixed").drop("mixed").hint("merge"), "key")


def _and_links(found: DataFrame, links: DataFrame) -> DataFrame:
    return found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)


def _repeats(sketches: DataFrame) -> bool:
    """Whether a document is there several times with the same id and text."""
    return bool(sketches.groupBy("doc_id", "f1", "f2").agg(F.count("*").alias("n")).filter("n > 1").take(1))


def one_of_each(docs: DataFrame, size: int = SHINGLE, alike: tuple[int, int] = SIMILAR) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: one of each group of near-duplicates by op7's contract.

    That contract takes ids for documents: of several rows with the same id the least one stays, whatever its text, and rows
    without an id all stay. Where ids may be null or repeated, see ``one_of_each_text``. Only rows that may have to go are shuffled.
    """
    path = work_path(docs.sparkSession, "near-duplicates-kept")
    near_duplicates(docs, size, alike).filter("NOT kept").select(F.xxhash64("doc_id").alias("key")).write.parquet(path)
    gone = docs.sparkSession.read.parquet(path)
    rows = _wrapped(docs, F.col("doc_id").cast("long").alias("own"), F.xxhash64(F.col("doc_id").cast("long")).alias("key"))
    kept = unlisted(rows, "key", gone)
    again = rows.filter("own IS NOT NULL").groupBy("own").agg(F.count("*").alias("n")).filter("n > 1").select("own")
    if not again.take(1):
        return kept.select("doc.*")
    least = _least(kept.join(again, "own", "left_semi"), ["own"])
    return kept.join(again, "own", "left_anti").select("doc").unionByName(least).select("doc.*")


def _wrapped(docs: DataFrame, *keys: Column) -> DataFrame:
    """The rows as a struct ``doc`` beside ``keys``, so that no name among their columns can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *keys)


def _least(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """``doc`` of one row for each key: the least as JSON, which columns of any type can be written as."""
    return rows.groupBy(*by).agg(F.min_by("doc", F.to_json("doc")).alias("doc")).select("doc")


def one_of_each_text(docs: DataFrame, size: int = SHINGLE, alike: tuple[int, int] = SIMILAR) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: one of each group of near-duplicate texts, whatever the ids are.

    Texts alone are linked: rows with the same id and different texts have nothing to do with each other, and rows without an id
    take part. Of a group the row with the smallest id stays, one without an id only where none has any. Texts without words all
    stay. A row is known by two hashes of its id and text, 128 bits together. Only rows that may have to go are shuffled.
    """
    spark = docs.sparkSession
    path = work_path(spark, "near-duplicate-texts")
    read = spark.read.parquet
    known_by, id_ = ["row_key", "row_check"], F.col("doc_id").cast("long")
    keys = [F.xxhash64(id_, "text").alias("row_key"), F.xxhash64(F.lit("check"), id_, "text").alias("row_check")]
    rows = docs.select(id_.alias("doc_id"), "text", *keys)
    _sketches(rows, size).write.parquet(f"{path}/sketches")
    sound = read(f"{path}/sketches").filter("n > 0")

    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", *known_by)).alias("first")
    classes = sound.groupBy("f1", "f2", "n").agg(first, F.count("*").alias("rows"))
    # Numbered when stored, so that classes are told apart by all bits of their fingerprints.
    classes.withColumn("id", F.monotonically_increasing_id()).write.parquet(f"{path}/classes")
    classes = read(f"{path}/classes")
    leaders = classes.select("id", *(F.col(f"first.{c}").alias(c) for c in known_by), "f1", "f2")
    keyed = sound.select(*known_by, "f1", "f2", "n", "keys").join(leaders, [*known_by, "f1", "f2"]).select("id", "n", "keys")
    repeated = sound.groupBy(*known_by).agg(F.count("*").alias("copies")).filter("copies > 1").select(*known_by)
    repeated.write.parquet(f"{path}/repeated")
    repeated = read(f"{path}/repeated")
    again = bool(repeated.take(1))
    if again:
        keyed = keyed.groupBy("id").agg(F.first("n").alias("n"), F.first("keys").alias("keys"))
    linked = _linked(rows.select("text", *known_by), known_by, leaders, keyed, again, path, size, alike).withColumnRenamed("node", "id")

    placed = classes.join(linked, "id", "left").withColumn("component", F.coalesce("component", "id"))
    stays = placed.groupBy("component").agg(F.min("first").alias("stays"), F.sum("rows").alias("rows")).filter("rows > 1")
    judged = placed.join(stays, "component").select("f1", "f2", "n", *(F.col(f"stays.{c}").alias(f"stays_{c}") for c in known_by))
    other = (F.col("row_key") != F.col("stays_row_key")) | (F.col("row_check") != F.col("stays_row_check"))
    gone = sound.select(*known_by, "f1", "f2", "n").join(judged, ["f1", "f2", "n"]).filter(other).select(*known_by).distinct()
    gone.write.parquet(f"{path}/gone")
    gone = read(f"{path}/gone")

    known = key_filter(gone, "row_key")
    marked = _wrapped(docs, *keys)
    maybe = filtered(marked, "row_key", known).join(gone, known_by, "left_anti").select(*marked.columns)
    kept = filtered(marked, "row_key", known, hit=False).unionByName(maybe)
    if not again:
        return kept.select("doc.*")
    # The same id and text several times.
    least = _least(kept.join(repeated, known_by, "left_semi"), known_by)
    return kept.join(repeated, known_by, "left_anti").select("doc").unionByName(least).select("doc.*")
