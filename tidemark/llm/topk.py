"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Components are quantised to whole numbers; a posting segment holds the vectors of a block that have the same value in the same
dimension, and a block's segments are stored by descending impact (absolute value). A search adds segments to accumulators from
the greatest impact down, for many queries at once. What is left unread of a vector is bounded by the norm of its smaller
components times the query's norm, and by the next impact times the sum of the query's components. It stops as soon as these
bounds prove that few vectors can still be among the k best; all of those are then scored exactly.

Queries come in blocks of bounded size, one pass over the stored index each, written before the next begins, so that driver and
tasks hold one block; a task keeps the best so far of each query, so later blocks start with a higher bar. Only k rows per query
and task are shuffled.

Vectors with a component of 2^26 or more after scaling, or with more than 1,024 components, are far: products with them may not fit
64 bits. They are kept beside the index, and every pair that has one is scored in whole numbers of any size. Scores beyond 64 bits are
given as the nearest long, and are still ranked by their exact values.

Defined cases: null ids, null and empty vectors, and vectors with null or non-finite components take no part (in columns of doubles
also those of 2^150 and more after scaling); rows with equal ids are vectors of their own; missing components of the shorter vector
are 0; columns but ``vec_id`` and ``embedding`` are never read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import work_path

SCALE = 64
#: Vectors to an index block.
BLOCK = 4096
#: Queries to a pass, and queries whose accumulators a task holds at a time.
PASS, BATCH = 16_384, 256
#: Impact steps after which the bounds are tried.
STEPS = 8
#: Share of a block's vectors that may be left when adding segments ends and exact scoring begins.
ENOUGH = 0.02
#: Scaled components and numbers of components from which on a vector is far, and components that count as not finite.
FAR, LONG, BEYOND = 1 << 26, 1 << 10, float(1 << 150)
#: Digits of a score between far vectors, far queries to a pass, and the greatest long.
DIGITS, FAR_PASS, MOST = 100, 1024, (1 << 63) - 1

INDEX = (
    "rows binary, vec_ids binary, width int, matrix binary, "
    "dims binary, impacts binary, ends binary, members binary"
)


def write_vectors(table: DataFrame, path: str, scale: int = SCALE) -> None:
    """Store ``row``, ``vec_id`` and floor(scale * x) of each component, in double precision: as ``values``, or of far vectors as ``far``.

    ``table``: ``vec_id``, ``embedding``.
    """
    x = F.col("embedding")
    whole = F.transform(x, lambda v: F.lit(float(scale)) * v.cast("double"))
    finite = F.forall(whole, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(BEYOND)))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter("vec_id IS NOT NULL")
    rows = rows.filter((F.size(x) > 0) & finite).select("vec_id", whole.alias("whole"))
    near = (F.size("whole") <= LONG) & F.forall("whole", lambda v: F.abs(v) < FAR)
    # A double from 2^52 on is whole already, and floor would make it a long.
    down = F.transform("whole", lambda v: F.when(F.abs(v) < F.lit(float(1 << 52)), F.floor(v).cast("double")).otherwise(v))
    rows = rows.select(
        "vec_id",
        F.when(near, F.transform("whole", lambda v: F.floor(v).cast("long"))).alias("values"),
        F.when(~near, down).alias("far"),
    )
    rows.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)


def _matrix(values: pa.Array) -> np.ndarray:
    """Ragged lists as a matrix; missing components are 0."""
    sizes = np.diff(np.asarray(values.offsets))
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, place] = values.flatten().to_numpy()
    return out


def write_index(vectors: DataFrame, path: str) -> None:
    """Store the blocks of the index over vectors (but far ones) as written by :func:`write_vectors`; one scan, no shuffle."""

    def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        matrix = _matrix(table["values"].chunk(0))
        member, dim = np.nonzero(matrix)
        value = matrix[member, dim]
        order = np.lexsort((member, value, dim, -np.abs(value)))
        member, dim, value = member[order], dim[order], value[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (dim[1:] != dim[:-1])
        heads = np.flatnonzero(new)
        ends = np.append(heads[1:], len(value)) if len(heads) else heads
        small = np.abs(matrix).max(initial=0) < 1 << 15
        raw = {
            "rows": table["row"].to_numpy().tobytes(),
            "vec_ids": table["vec_id"].to_numpy().tobytes(),
            "matrix": matrix.astype(np.int16 if small else np.int64).tobytes(),
            "dims": dim[heads].astype(np.int32).tobytes(),
            "impacts": value[heads].astype(np.int64).tobytes(),
            "ends": ends.astype(np.int64).tobytes(),
            "members": member.astype(np.uint16).tobytes(),
        }
        columns = {k: pa.array([v], pa.binary()) for k, v in raw.items()} | {"width": pa.array([matrix.shape[1]], pa.int32())}
        names = [c.split()[0] for c in INDEX.split(", ")]
        return pa.record_batch({n: columns[n] for n in names})

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

    vectors.filter("values IS NOT NULL").select("row", "vec_id", "values").mapInArrow(run, INDEX).write.parquet(path)


class Block:
    """One row of the index."""

    def __init__(self, row: dict):
        def array(name: str, kind) -> np.ndarray:
            return np.frombuffer(row[name].as_buffer(), kind)

        self.rows, self.vec_ids = array("rows", np.int64), array("vec_ids", np.int64)
        n, width = len(self.rows), row["width"].as_py()
        kind = np.int16 if len(row["matrix"].as_buffer()) == 2 * n * width else np.int64
        self.matrix = array("matrix", kind).reshape(n, width)
        self.dims, self.impacts = array("dims", np.int32), array("impacts", np.int64)
        self.ends, self.members = array("ends", np.int64), array("members", np.uint16)
        size = np.abs(self.impacts)
        # Steps end between two impacts, about the same number of postings apart.
        goal = np.arange(1, STEPS) * len(self.members) // STEPS
        cuts = np.searchsorted(self.ends, goal) if len(self.ends) else goal
        edges = np.flatnonzero(np.append(size[1:] != size[:-1], True)) + 1 if len(size) else np.zeros(0, np.int64)
        self.steps = np.unique(edges[np.searchsorted(edges, cuts)]) if len(edges) else edges
        self.steps = np.unique(np.append(self.steps, len(size)))
        square = self.matrix.astype(np.float64) ** 2
        self.rest = []  # by step: norm of what is not read yet, and the next impact
        for step in self.steps:
            nxt = int(size[step]) if step < len(size) else 0
            self.rest.append((np.sqrt((square * (np.abs(self.matrix) <= nxt)).sum(1)), nxt))

    def search(self, queries: np.ndarray, bar: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query number, member and exact score of every vector that may be among the k best; ``bar``: scores to reach."""
        width = min(queries.shape[1], self.matrix.shape[1])
        across = np.ascontiguousarray(queries[:, :width].T)
        total = np.zeros((len(self.rows), len(queries)), queries.dtype)
        norm = np.sqrt((across.astype(np.float64) ** 2).sum(0))
        absolute = np.abs(across).sum(0).astype(np.float64)
        at = 0
        for i, step in enumerate(self.steps):
            for s in range(at, step):
                d = self.dims[s]
                if d < width:
                    mine = self.members[self.ends[s - 1] if s else 0 : self.ends[s]]
                    total[mine] += self.impacts[s].astype(queries.dtype) * across[d]
            at = step
            rest, nxt = self.rest[i]
            if 2 * (i + 1) < len(self.steps):
                continue
            bound = np.minimum(rest[:, None] * norm, nxt * absolute) * (1 + 1e-9)
            if len(self.rows) > k:
                low = np.partition(total - bound, len(self.rows) - k, axis=0)[len(self.rows) - k]
                bar = np.maximum(bar, low)
            alive = total + bound >= bar
            if nxt == 0 or alive.mean() <= ENOUGH:
                break
        member, query = np.nonzero(alive)
        if nxt == 0:
            return query, member, total[member, query].astype(np.int64)
        score = np.empty(len(member), np.int64)
        for a in range(0, len(member), 1 << 16):
            b = slice(a, a + (1 << 16))
            score[b] = np.einsum(
                "ij,ij->i", self.matrix[member[b], :width].astype(queries.dtype), queries[query[b], :width], dtype=np.int64
            )
        keep = score >= bar[query]
        return query[keep], member[keep], score[keep]


class Best:
    """The k best of each query so far: by score, then by smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.query = np.zeros(0, np.int64)
        self.row, self.vec_id, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.bar = np.full(n, -np.inf)

    def add(self, query: np.ndarray, row: np.ndarray, vec_id: np.ndarray, score: np.ndarray) -> None:
        query, row = np.append(self.query, query), np.append(self.row, row)
        vec_id, score = np.append(self.vec_id, vec_id), np.append(self.score, score)
        order = np.lexsort((row, vec_id, -score, query))
        query = query[order]
        counts = np.bincount(query, minlength=len(self.bar))
        rank = np.arange(len(query)) - np.repeat(np.cumsum(counts) - counts, counts)
        keep = order[rank < self.k]
        self.query, self.row, self.vec_id, self.score = query[rank < self.k], row[keep], vec_id[keep], score[keep]
        full = counts >= self.k
        last = np.cumsum(np.minimum(counts, self.k)) - 1
        self.bar[full] = self.score[last[full]]


def search(spark: SparkSession, index_path: str, queries: DataFrame, k: int, vectors: DataFrame | None = None) -> DataFrame:
    """``query_row``, ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's k best rows but its own.

    ``queries``: rows of the stored ``vectors``, which are needed as well where some of them are far. Ties go to the smaller vec_id,
    then to the earlier row.
    """
    path = work_path(spark, "top-k")
    index = spark.read.parquet(index_path)
    near = queries.filter("values IS NOT NULL")
    n = 0
    for rows, ids, values in _blocks(near, "values", PASS):
        _pass(index, rows, ids, _matrix(pa.array(values, pa.list_(pa.int64()))), k).write.parquet(f"{path}/near/pass={n}")
        n += 1
    found = spark.read.schema(FOUND).parquet(f"{path}/near")
    order: list[Column] = [F.desc("score")]
    if vectors is not None and vectors.filter("far IS NOT NULL").take(1):
        far = vectors.filter("far IS NOT NULL")
        whole = F.coalesce("far", F.col("values").cast("array<double>")).alias("whole")
        n = 0
        for some, among in ((near, far), (queries.filter("far IS NOT NULL"), vectors)):
            for rows, ids, values in _blocks(some.select("row", "vec_id", whole), "whole", FAR_PASS):
                if rows.size:
                    _far_pass(among.select("row", "vec_id", whole), rows, ids, values, k).write.parquet(f"{path}/far/pass={n}")
                    n += 1
        if n:
            digits = F.lpad(F.abs("score").cast("string"), DIGITS, "0")
            least = F.translate(digits, "0123456789", "9876543210")
            same = F.when(F.col("score") < 0, F.concat(F.lit("0"), least)).otherwise(F.concat(F.lit("1"), digits))
            found = found.withColumn("exact", same).unionByName(spark.read.schema(f"{FOUND}, exact string").parquet(f"{path}/far"))
            order = [F.desc("exact")]
    by_query = Window.partitionBy("query_row").orderBy(*order, "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k)
    return ranked.select("query_row", "query_id", "rank", "vec_id", "score")


FOUND = "query_row long, query_id long, row long, vec_id long, score long"


def _sortable(score: int) -> str:
    """Text in whose order whole numbers of up to ``DIGITS`` digits are."""
    digits = str(abs(score)).zfill(DIGITS)
    return "1" + digits if score >= 0 else "0" + digits.translate(str.maketrans("0123456789", "9876543210"))


def _far_pass(among: DataFrame, rows: np.ndarray, ids: np.ndarray, values: list, k: int) -> DataFrame:
    """The k best among some vectors for each of a block of queries, by whole numbers of any size."""
    own = [[int(x) for x in v] for v in values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in own]
        for batch in batches:
            for row, vec_id, whole in zip(*(batch.column(i).to_pylist() for i in range(3))):
                vector = [int(x) for x in whole]
                for q, query in enumerate(own):
                    if row != rows[q]:
                        entry = (sum(a * b for a, b in zip(query, vector)), -vec_id, -row)
                        (heapq.heappush if len(best[q]) < k else heapq.heappushpop)(best[q], entry)
        out = [(int(rows[q]), int(ids[q]), -r, -v, max(-MOST - 1, min(MOST, s)), _sortable(s)) for q, b in enumerate(best) for s, v, r in b]
        kinds = [pa.int64()] * 5 + [pa.string()]
        columns = list(zip(*out)) if out else [[]] * 6
        names = ["query_row", "query_id", "row", "vec_id", "score", "exact"]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)

    return among.mapInArrow(run, f"{FOUND}, exact string")


def _blocks(queries: DataFrame, column: str, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Row numbers, ids and components of the queries, ``size`` at a time; one block, perhaps empty, at least."""
    rows: list = []
    first = True
    for r in queries.select("row", "vec_id", column).toLocalIterator(prefetchPartitions=True):
        rows.append(r)
        if len(rows) == size:
            yield _packed(rows)
            rows, first = [], False
    if rows or first:
        yield _packed(rows)


def _packed(rows: list) -> tuple[np.ndarray, np.ndarray, list]:
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), [r[2] for r in rows]


def _pass(index: DataFrame, rows: np.ndarray, ids: np.ndarray, values: np.ndarray, k: int) -> DataFrame:
    largest = int(np.abs(values).max(initial=0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(rows), k + 1)  # the query's own row may be one
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block({c: batch.column(c)[i] for c in batch.schema.names})
                reach = largest * int(np.abs(block.impacts).max(initial=0)) * max(1, values.shape[1])
                kind = np.int32 if reach < 1 << 31 else np.int64
                for a in range(0, len(rows), BATCH):
                    own = values[a : a + BATCH].astype(kind)
                    query, member, score = block.search(own, best.bar[a : a + BATCH], k + 1)
                    best.add(query + a, block.rows[member], block.vec_ids[member], score)
        keep = best.row != rows[best.query]
        query = best.query[keep]
        yield pa.record_batch(
            {
                "query_row": pa.array(rows[query]),
                "query_id": pa.array(ids[query]),
                "row": pa.array(best.row[keep]),
                "vec_id": pa.array(best.vec_id[keep]),
                "score": pa.array(best.score[keep]),
            }
        )

    return index.mapInArrow(run, "query_row long, query_id long, row long, vec_id long, score long")
