"""Quality of texts by a factorisation machine over hashed words, structure statistics and metadata.

The score of a row x is ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j`` through a logistic function. The pair sum is taken
in linear time as half of ``(sum v_i x_i)^2 - sum v_i^2 x_i^2``, factor by factor. The machine is fitted on the driver on a
bounded sample of labelled rows, and scores all documents in one scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import held_out, training_sample
from tidemark.llm.words import NON_SPACE, cut, give_back, lower_ascii, pieces, text_bytes

#: Labelled rows a machine is fitted on at most, a fifth of them for calibration.
ROWS = 12_000
BUCKETS = 1 << 13
FACTORS = 8
HELD_OUT = (4, 2)
THRESHOLD = 0.7


def _kind(test) -> np.ndarray:
    return np.array([bool(test(b)) for b in range(256)])


_KINDS = {
    "letters": _kind(lambda b: chr(b).isascii() and chr(b).isalpha() or b >= 0x80),
    "capitals": _kind(lambda b: 0x41 <= b <= 0x5A),
    "digits": _kind(lambda b: 0x30 <= b <= 0x39),
    "stops": _kind(lambda b: chr(b) in ".,;:"),
    "shouts": _kind(lambda b: chr(b) in "!?"),
    "signs": _kind(lambda b: chr(b) in "#$%&*@^~_+=<>{}[]\\/"),
    "bars": _kind(lambda b: chr(b) == "|"),
    "spaces": ~NON_SPACE,
}
_NOT_LINE_END = _kind(lambda b: b != 0x0A)
STATISTICS = len(_KINDS) + 9  # with the metadata


@dataclass
class Sparse:
    """Rows of (column, value), row by row; every row has all ``STATISTICS`` after its words."""

    first: np.ndarray
    column: np.ndarray
    value: np.ndarray


def features(batch: pa.RecordBatch) -> Sparse:
    """Hashed words (counts, damped and of length 1 together) and structure statistics of each whole text."""
    data, offsets = text_bytes(batch.column("text"))
    n = batch.num_rows
    low = lower_ascii(data)
    words = cut(low, offsets, NON_SPACE)
    bucket = (words.hashes() % np.uint64(BUCKETS)).astype(np.int64)
    doc = words.doc
    key, count = np.unique(doc * BUCKETS + bucket, return_counts=True)
    row, column = key // BUCKETS, key % BUCKETS
    value = 1 + np.log(count)
    norm = np.sqrt(np.bincount(row, value * value, n))
    value = value / norm[row]

    n_words = words.counts.astype(np.float64)
    some = np.maximum(n_words, 1)
    size = np.maximum(np.diff(offsets), 1).astype(np.float64)
    stats = []
    for kind in _KINDS.values():
        stats.append(np.sqrt(np.diff(np.append(0, np.cumsum(kind[data]))[offsets]) / size))
    different = np.bincount(row, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, row, count)
    same = np.zeros(len(bucket), bool)
    same[1:] = (bucket[1:] == bucket[:-1]) & (doc[1:] == doc[:-1])
    lines = cut(low, offsets, _NOT_LINE_END)
    line_rows = lines.doc
    line_keys = np.unique(np.stack([line_rows.astype(np.uint64), lines.hashes()]), axis=1) if len(line_rows) else None
    different_lines = np.bincount(line_keys[0].astype(np.int64), minlength=n) if line_keys is not None else np.zeros(n)
    chars = batch.column("n_chars").fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    stats += [
        np.log1p(n_words) / 8,
        different / some,
        np.minimum(different / np.maximum(8 * np.sqrt(n_words), 1), 2),
        np.sqrt(top / some),
        np.sqrt(np.bincount(doc[same], minlength=n) / some),
        np.minimum(size / some / 12, 2),
        1 - different_lines / np.maximum(lines.counts, 1),
        np.log1p(lines.counts) / 6,
        np.log1p(np.maximum(chars, 0)) / 12,
    ]
    dense = np.stack(stats, axis=1)
    columns = np.concatenate([column, np.tile(BUCKETS + np.arange(STATISTICS), n)])
    rows = np.concatenate([row, np.repeat(np.arange(n), STATISTICS)])
    values = np.concatenate([value, dense.reshape(-1)])
    order = np.argsort(rows, kind="stable")
    first = np.append(0, np.cumsum(np.bincount(rows, minlength=n)))
    return Sparse(first, columns[order].astype(np.int32), values[order].astype(np.float32))


@dataclass
class Machine:
    """A fitted factorisation machine; ``scale`` and ``shift`` calibrate its sum."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def prepared(self, x: Sparse) -> np.ndarray:
        """Values with the statistics centred and scaled."""
        value = x.value.copy()
        stat = x.column >= BUCKETS
        at = x.column[stat] - BUCKETS
        value[stat] = np.clip((value[stat] - self.centre[at]) / self.spread[at], -4, 4)
        return value

    def margin(self, x: Sparse) -> np.ndarray:
        value = self.prepared(x)
        heads = x.first[:-1]
        if not len(heads):
            return np.zeros(0)
        total = self.bias + np.add.reduceat(self.weight[x.column] * value, heads)
        for f in range(self.factor.shape[1]):
            term = self.factor[x.column, f] * value
            total = total + 0.5 * (np.add.reduceat(term, heads) ** 2 - np.add.reduceat(term * term, heads))
        return total

    def score(self, x: Sparse) -> np.ndarray:
        return _logistic(self.scale * self.margin(x).astype(np.float64) + self.shift)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(
    x: Sparse, label: np.ndarray, calibration: np.ndarray, order: np.ndarray, epochs: int = 12, seed: int = 5
) -> Machine:
    """Adam on the logistic loss over the rows not marked for ``calibration``, then two calibration parameters on those.

    ``order`` is one of the rows that does not hang on how Spark delivered them. Without rows every score is 1/2; with labels of one kind only the bias is learned.
    """
    width = BUCKETS + STATISTICS
    rng = np.random.default_rng(seed)
    stat = x.column >= BUCKETS
    dense = x.value[stat].reshape(-1, STATISTICS) if len(label) else np.zeros((1, STATISTICS), np.float32)
    machine = Machine(
        0.0,
        np.zeros(width, np.float32),
        rng.normal(0, 0.02, (width, FACTORS)).astype(np.float32),
        dense.mean(0),
        np.maximum(dense.std(0), 0.02),
    )
    if not len(label):
        machine.factor[:] = 0
        return machine
    value = machine.prepared(x)
    rate = np.clip(label.mean(), 0.01, 0.99)
    machine.bias = float(np.log(rate / (1 - rate)))
    if label.min() == label.max():
        machine.factor[:] = 0
        return machine
    own = order[~calibration[order]]
    moments = [np.zeros_like(a) for a in (machine.weight, machine.weight, machine.factor, machine.factor)]
    step = 0
    for epoch in range(epochs):
        pace = 0.02 * (1 - epoch / epochs)
        for some in np.array_split(rng.permutation(own), max(1, len(own) // 256)):
            sizes = x.first[some + 1] - x.first[some]
            entry = np.repeat(x.first[some] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            column, v = x.column[entry], value[entry]
            heads = np.cumsum(sizes) - sizes
            terms = machine.factor[column] * v[:, None]
            sums = np.add.reduceat(terms, heads)
            z = machine.bias + np.add.reduceat(machine.weight[column] * v, heads)
            z = z + 0.5 * (sums**2 - np.add.reduceat(terms * terms, heads)).sum(1)
            slope = (_logistic(z) - label[some]) / len(some)
            machine.bias -= 0.5 * float(slope.sum())
            each = np.repeat(slope, sizes) * v
            row = np.repeat(np.arange(len(some)), sizes)
            grad_w = np.bincount(column, each, width).astype(np.float32) + 1e-5 * machine.weight
            grad_v = np.empty_like(machine.factor)
            for f in range(FACTORS):
                grad_v[:, f] = np.bincount(column, each * (sums[row, f] - terms[:, f]), width)
            grad_v += 1e-4 * machine.factor
            step += 1
            for target, grad, i in ((machine.weight, grad_w, 0), (machine.factor, grad_v, 2)):
                moments[i] += 0.1 * (grad - moments[i])
                moments[i + 1] += 0.01 * (grad * grad - moments[i + 1])
                mean, square = moments[i] / (1 - 0.9**step), moments[i + 1] / (1 - 0.99**step)
                target -= (pace * mean / (np.sqrt(square) + 1e-6)).astype(np.float32)
    held = order[calibration[order]]
    if len(held) >= 50 and label[held].min() < label[held].max():
        z, y = machine.margin(x)[held].astype(np.float64), label[held]
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton steps, with a slight pull towards leaving the margin as it is
            p = _logistic(a * z + b)
            g = np.array([((p - y) * z).sum() + (a - 1), (p - y).sum() + 0.01 * b])
            s = p * (1 - p)
            h = np.array([[(s * z * z).sum() + 1, (s * z).sum()], [(s * z).sum(), s.sum() + 0.01]])
            da, db = np.linalg.solve(h, g)
            a, b = a - da, b - db
        if a > 0:
            machine.scale, machine.shift = float(a), float(b)
    return machine


def _readable(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``n_chars`` (0 where the table has none)."""
    chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(0).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", chars.alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = ROWS) -> Machine:
    """Fit on at most ``rows`` labelled rows that are not held out."""
    sample = training_sample(_readable(docs), labels, label, held_out(F.col("doc_id"), *HELD_OUT), rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            x = features(batch)
            bounds = pa.array(x.first.astype(np.int32))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "label": batch.column("label"),
                    "part": batch.column("part"),
                    "columns": pa.ListArray.from_arrays(bounds, pa.array(x.column)),
                    "values": pa.ListArray.from_arrays(bounds, pa.array(x.value)),
                }
            )

    schema = "doc_id long, label int, part int, columns array<int>, values array<float>"
    found = sample.select("doc_id", "text", "n_chars", "label", "part").mapInArrow(run, schema).toArrow()
    sizes = np.concatenate([np.zeros(1, np.int64), *(c.value_lengths().to_numpy() for c in found["columns"].chunks)])
    column, value = (
        np.concatenate([np.zeros(0, kind), *(c.flatten().to_numpy() for c in found[name].chunks)])
        for name, kind in (("columns", np.int32), ("values", np.float32))
    )
    ids, label_of, part = (found[c].to_numpy() for c in ("doc_id", "label", "part"))
    del found
    x = Sparse(np.cumsum(sizes), column, value)
    machine = fit(x, label_of.astype(np.float64), part < 2, np.argsort(ids, kind="stable"))
    del x, column, value
    give_back()
    return machine


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row; null is an empty text. One scan, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "score": pa.array(machine.score(features(batch)))}
            )

    scored = _readable(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), *HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


#: Bytes of text that a task of the stage works on at a time.
PIECE = 1 << 20


def keep(docs: DataFrame, machine: Machine) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches ``THRESHOLD``. One scan, no shuffle.

    Null and empty texts are scored like any other (alike), ids do not matter, repeated rows stay or go together, an empty table stays empty.
    """
    chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(0).cast("long")
    width, at = len(docs.columns), docs.columns.index("text")
    numbered = docs.toDF(*(f"c{i}" for i in range(width)))
    rows = docs.select(*docs.columns, chars.alias("chars")).toDF(*numbered.columns, "chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, f"c{at}", PIECE):
            seen = pa.record_batch({"text": batch.column(at), "n_chars": batch.column(width)})
            yield batch.filter(pa.array(machine.score(features(seen)) >= THRESHOLD)).select(range(width))
        give_back()

    return rows.mapInArrow(run, numbered.schema).toDF(*docs.columns)
