"""Centroid clustering (Lloyd's rounds) over a VA-file: exact whole-number arithmetic, full vectors only where bounds overlap.

Components are quantised to whole numbers. Beside each block of vectors stands its approximation: a cell of few bits per
dimension, cut at the quantiles of a normal distribution with the dimension's mean and deviation over all vectors, closed by its
least and greatest value. In each round a task makes two lookup tables, the least and the greatest squared distance from every
centroid to every cell, adds them up over the dimensions, and so has an interval per vector and centroid. A centroid whose least
distance is above another's greatest is out. Vectors with one centroid left are decided by their cells; of the others the full
vectors are fetched and the exact distances to the centroids that are left are compared.

A round's sums come from whole vectors, which no bound can replace: every task adds up its own, so k rows per task are shuffled.
What reaches the driver is k centroids, and four numbers per dimension for the cells. Distances and sums are exact at any size:
components of 2^25 and more are worked on as Python integers, sums as two halves of 38-digit decimals.

Defined cases: vectors with another number of components, with null or non-finite components (in columns of doubles also those
of 2^150 and more after scaling), or null, take no part. Rows with equal
or null ids are vectors of their own; a null id is last in the choice of first centroids. Ties go to the centroid of the smaller number,
fewer vectors than centroids make fewer centroids, an empty table gives an empty result. Distances and their sums beyond 2^63 - 1
are given as 2^63 - 1; they are still compared exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.words import give_back
from tidemark.session import work_path

SCALE = 64
#: Vectors to a block, and bits to a cell.
BLOCK, BITS = 4096, 6
#: Below this, squares and their sums over 2^10 dimensions fit in 64 bits.
_NARROW, _DIMS = 1 << 25, 1 << 10
#: Components from here on, which only double columns can hold, count as not finite.
_BEYOND = float(1 << 150)
_HALF = 1 << 60
_MOST = (1 << 63) - 1

_BLOCKS = (
    "vec_ids binary, named binary, values binary, wide boolean, n long, "
    "least array<double>, most array<double>, total array<double>, square array<double>"
)
_SUMS = "cluster int, n long, high array<decimal(38,0)>, low array<decimal(38,0)>, fetched long"


def write_vectors(table: DataFrame, path: str, dims: int, scale: int = SCALE) -> None:
    """Store the vectors of ``table`` (``vec_id``, ``embedding``; nothing else is read) in blocks, with their sums per dimension."""
    x = F.col("embedding")
    # Scaled by a power of two and rounded down, a double is a whole number without any error.
    scaled = lambda v: v.cast("double") * F.lit(float(scale))
    whole = F.transform(x, scaled)
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(scaled(v)) < F.lit(_BEYOND)))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter((F.size(x) == dims) & sound)

    def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        ids, values = table["vec_id"].combine_chunks(), np.floor(_floats(table["values"].combine_chunks())).reshape(-1, dims)
        wide = bool(np.abs(values).max(initial=0) >= _NARROW)
        spread = {"least": values.min(0), "most": values.max(0), "total": values.sum(0), "square": (values**2).sum(0)}
        if not wide:
            small = np.abs(values).max(initial=0) < 1 << 15
            values = values.astype(np.int16 if small else np.int32)
        return pa.record_batch(
            {
                "vec_ids": pa.array([ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes()], pa.binary()),
                "named": pa.array([ids.is_valid().to_numpy(zero_copy_only=False).tobytes()], pa.binary()),
                "values": pa.array([values.tobytes()], pa.binary()),
                "wide": pa.array([wide]),
                "n": pa.array([len(ids)], pa.int64()),
                **{name: pa.array([v.tolist()], pa.list_(pa.float64())) for name, v in spread.items()},
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, BLOCK - size)
                held.append(part)
                at, size = at + part.num_rows, size + part.num_rows
                if size == BLOCK:
                    yield block(held)
                    held, size = [], 0
        if size:
            yield block(held)

    rows.select("vec_id", whole.alias("values")).mapInArrow(run, _BLOCKS).write.parquet(path)


def _floats(lists: pa.ListArray) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False)


def cell_edges(spark: SparkSession, path: str, bits: int = BITS) -> np.ndarray:
    """Edges of the cells, a row per dimension: a cell holds the whole numbers from its edge to below the next one's.

    The first is the least value, the last above the greatest, the others are normal quantiles. Covers all vectors.
    """
    names = ("least", "most", "total", "square")
    rows = spark.read.parquet(path).select("n", F.posexplode(F.arrays_zip(*names)).alias("dim", "of"))
    found = rows.groupBy("dim").agg(
        F.sum("n").alias("n"), F.min("of.least").alias("least"), F.max("of.most").alias("most"),
        F.sum("of.total").alias("total"), F.sum("of.square").alias("square"),
    )
    stats = sorted(found.collect(), key=lambda r: r["dim"])
    cells = 1 << bits
    inner = np.array([NormalDist().inv_cdf(i / cells) for i in range(1, cells)])
    out = np.zeros((len(stats), cells + 1))
    for d, r in enumerate(stats):
        mean = r["total"] / r["n"]
        deviation = np.sqrt(max(0.0, r["square"] / r["n"] - mean * mean))
        above = r["most"] + 1
        out[d] = np.clip(np.ceil([r["least"], *(mean + deviation * inner), above]), r["least"], above)
    return out


def write_cells(spark: SparkSession, vectors: str, path: str, edges: np.ndarray) -> None:
    """Store the VA-file: the blocks of ``vectors`` with ``cells``, a byte per dimension, by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                values = _Block(batch, i, len(edges)).values
                cells = np.empty(values.shape[::-1], np.uint8)
                for d, row in enumerate(edges):
                    cells[d] = np.clip(np.searchsorted(row[1:-1], values[:, d], "right"), 0, len(row) - 2)
                one = batch.slice(i, 1)
                columns = {name: one.column(name) for name in ("vec_ids", "named", "values", "wide", "n")}
                yield pa.record_batch(columns | {"cells": pa.array([cells.tobytes()], pa.binary())})

    schema = "vec_ids binary, named binary, values binary, wide boolean, n long, cells binary"
    spark.read.parquet(vectors).mapInArrow(run, schema).write.parquet(path)


class _Block:
    def __init__(self, batch: pa.RecordBatch, i: int, dims: int):
        raw = lambda name: batch.column(name)[i].as_buffer()
        self.wide, n = batch.column("wide")[i].as_py(), batch.column("n")[i].as_py()
        width = len(raw("values")) // (n * dims)
        kind = np.float64 if self.wide else {2: np.int16, 4: np.int32}[width]
        self.values = np.frombuffer(raw("values"), kind).reshape(n, dims)
        self.ids = np.frombuffer(raw("vec_ids"), np.int64)
        self.named = np.frombuffer(raw("named"), bool)
        if "cells" in batch.schema.names:
            self.cells = np.frombuffer(raw("cells"), np.uint8).reshape(dims, n)


class Tables:
    """For one set of centroids: tables of the least and greatest squared distance from each centroid to each cell."""

    def __init__(self, centroids: list[list[int]], edges: np.ndarray):
        self.exact = centroids
        self.wide = any(abs(x) >= _NARROW for c in centroids for x in c)
        self.points = np.array(centroids, np.float64)
        low = edges[:, :-1, None]
        high = np.maximum(low, edges[:, 1:, None] - 1)
        at = self.points.T[:, None, :]
        # float32 halves what is moved; rounding is made up for in ``left``.
        with np.errstate(over="ignore", invalid="ignore"):
            self.least = (np.maximum(0, np.maximum(low - at, at - high)) ** 2).astype(np.float32)
            self.most = (np.maximum(np.abs(at - low), np.abs(at - high)) ** 2).astype(np.float32)
        # Beyond that, differences of doubles are no longer exact enough: every centroid is left.
        self.sound = bool(np.isfinite(edges).all()) and not self.wide and np.abs(edges).max(initial=0) < 1 << 50

    def left(self, cells: np.ndarray) -> np.ndarray:
        """Which centroids (columns) may be the nearest of each vector (row), by the intervals alone."""
        if not self.sound:
            return np.ones((cells.shape[1], len(self.exact)), bool)
        least = np.zeros((cells.shape[1], len(self.exact)), np.float32)
        most = np.zeros_like(least)
        for d, own in enumerate(cells):
            least += self.least[d][own]
            most += self.most[d][own]
        slack = 1 + 4e-7 * (len(cells) + 2)
        return least / slack <= most.min(1, keepdims=True) * slack

    def distances(self, values: np.ndarray, vector: np.ndarray, centroid: np.ndarray, wide: bool) -> np.ndarray:
        """Exact squared distances of pairs: int64, or Python integers where 64 bits may not do."""
        if wide or self.wide:
            out = np.empty(len(vector), object)
            for i, (v, c) in enumerate(zip(vector, centroid)):
                out[i] = sum((int(x) - y) ** 2 for x, y in zip(values[v], self.exact[c]))
            return out
        points = self.points.astype(np.int64)
        out = np.empty(len(vector), np.int64)
        for a in range(0, len(vector), 1 << 14):
            gap = values[vector[a : a + (1 << 14)]] - points[centroid[a : a + (1 << 14)]]
            out[a : a + (1 << 14)] = np.einsum("ij,ij->i", gap, gap)
        return out

    def nearest(self, block: _Block) -> tuple[np.ndarray, int]:
        """The nearest centroid of each vector, ties to the smaller number, and how many full vectors that took."""
        left = self.left(block.cells)
        cluster = left.argmax(1)
        open_ = np.flatnonzero(left.sum(1) > 1)
        row, centroid = np.nonzero(left[open_])
        if len(row):
            away = self.distances(block.values, open_[row], centroid, block.wide)
            # Pairs come by vector and centroid; a stable sort by distance within a vector leaves ties in centroid order.
            order = np.lexsort((centroid, away, row)) if away.dtype != object else np.array(sorted(range(len(row)), key=lambda i: (row[i], away[i], centroid[i])))
            first = np.append(True, row[order][1:] != row[order][:-1])
            cluster[open_] = centroid[order][first]
        return cluster, len(open_)


def first_centroids(spark: SparkSession, path: str, dims: int, k: int, seed: int = 1) -> list[list[int]]:
    """The ``k`` vectors with the least sha256 of ``seed:vec_id``, in that order; of equal ids the less by its components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[str, list[float]]] = []
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block(batch, i, dims)
                # A null id comes after every hash.
                names = [hashlib.sha256(f"{seed}:{v}".encode()).hexdigest() if ok else "~" for v, ok in zip(block.ids.tolist(), block.named)]
                bar = best[-1][0] if len(best) == k else "~~"
                best += [(name, block.values[row].astype(np.float64).tolist()) for row, name in enumerate(names) if name <= bar]
                best = sorted(best)[:k]
        if best:
            values = pa.array([v for _, v in best], pa.list_(pa.float64()))
            yield pa.record_batch({"hash": pa.array([h for h, _ in best]), "values": values})

    rows = spark.read.parquet(path).mapInArrow(run, "hash string, values array<double>")
    return [[int(x) for x in r["values"]] for r in rows.orderBy("hash", "values").limit(k).collect()]


def _round(spark: SparkSession, path: str, edges: np.ndarray, centroids: list[list[int]]) -> tuple[list[list[int]], int]:
    """Centroids after one round of assignment and update, and how many full vectors were fetched to decide."""
    dims, tables = len(edges), Tables(centroids, edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, fetched = [[0] * dims for _ in centroids], [0] * len(centroids), 0
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block(batch, i, dims)
                cluster, n = tables.nearest(block)
                fetched += n
                for c in np.unique(cluster):
                    own = block.values[cluster == c]
                    total = [sum(int(x) for x in col) for col in own.T] if block.wide else own.sum(0, dtype=np.int64).tolist()
                    sums[c] = [a + b for a, b in zip(sums[c], total)]
                    counts[c] += len(own)
        give_back()
        used = [c for c, n in enumerate(counts) if n]
        if not used:
            return
        digits = pa.list_(pa.decimal128(38, 0))
        yield pa.record_batch(
            {
                "cluster": pa.array(used, pa.int32()),
                "n": pa.array([counts[c] for c in used], pa.int64()),
                "high": pa.array([[Decimal(x // _HALF) for x in sums[c]] for c in used], digits),
                "low": pa.array([[Decimal(x % _HALF) for x in sums[c]] for c in used], digits),
                "fetched": pa.array([fetched if c == used[0] else 0 for c in used], pa.int64()),
            }
        )

    parts = spark.read.parquet(path).mapInArrow(run, _SUMS)
    total = lambda name, d: F.sum(F.get(name, F.lit(d)))
    found = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"),
        F.sum("fetched").alias("fetched"),
        F.array(*[total("high", d) for d in range(dims)]).alias("high"),
        F.array(*[total("low", d) for d in range(dims)]).alias("low"),
    )
    after = list(centroids)
    fetched = 0
    for r in found.collect():
        after[r["cluster"]] = [(int(h) * _HALF + int(w)) // r["n"] for h, w in zip(r["high"], r["low"])]
        fetched += r["fetched"]
    return after, fetched


def _assigned(spark: SparkSession, path: str, edges: np.ndarray, centroids: list[list[int]]) -> DataFrame:
    dims, tables = len(edges), Tables(centroids, edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block(batch, i, dims)
                cluster, _ = tables.nearest(block)
                away = tables.distances(block.values, np.arange(len(cluster)), cluster, block.wide)
                if away.dtype == object:
                    away = np.array([min(int(x), _MOST) for x in away], np.int64)
                yield pa.record_batch(
                    {
                        "vec_id": pa.array(block.ids, pa.int64(), mask=~block.named),
                        "cluster": pa.array(cluster, pa.int32()),
                        "distance": pa.array(away, pa.int64()),
                    }
                )

    return spark.read.parquet(path).mapInArrow(run, "vec_id long, cluster int, distance long")


def clusters(table: DataFrame, dims: int = 64, k: int = 16, rounds: int = 3, scale: int = SCALE, bits: int = BITS) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector with ``dims`` sound components."""
    if not 0 < dims <= _DIMS:
        raise ValueError(f"vectors of 1 to {_DIMS} components")
    spark = table.sparkSession
    root = work_path(spark, "clusters")
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    write_vectors(table, f"{root}/vectors", dims, scale)
    centroids = first_centroids(spark, f"{root}/vectors", dims, k)
    if not centroids:
        return spark.createDataFrame([], schema)
    edges = cell_edges(spark, f"{root}/vectors", bits)
    write_cells(spark, f"{root}/vectors", f"{root}/cells", edges)
    for _ in range(rounds):
        centroids, _ = _round(spark, f"{root}/cells", edges, centroids)
    _assigned(spark, f"{root}/cells", edges, centroids).write.parquet(f"{root}/assigned")
    found = spark.read.parquet(f"{root}/assigned")
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    # One row per centroid: k, a parameter, whatever the data's size.
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
    within = {r["cluster"]: int(r["own"]) for r in per.collect()}
    lines = [(c, min(x, _MOST), min(sum(within.values()), _MOST), digest[c]) for c, x in within.items()]
    about = spark.createDataFrame(lines, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(*[c.split()[0] for c in schema.split(", ")])
