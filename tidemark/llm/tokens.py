"""Token ids of whole documents, written as Simple-8b block files and read back.

Ids come from a given vocabulary file through the ``tokenizers`` library. The library is slow on running text, and its
byte-level model never looks across the pieces its pattern cuts; so a batch is cut into those pieces with numpy, and the
library's model encodes every different piece once. Texts with characters whose class this module does not know for sure, or with
the text of a special token, are given to the library whole.

Storage is Parquet, one row per segment: the payload is a Simple-8b file (head, word offset of each block, escapes, words),
beside it the documents' ids and lengths and the number of ids before the segment in its shard. So Spark's committer, its
retries and every store it can reach apply. Shards are ranges of doc_id in ascending order.
"""

from __future__ import annotations

import itertools
import json
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.simple8b import pack, unpack
from tidemark.llm.words import pieces, text_bytes

END_ID = 2
#: Ids to a segment; a segment always holds whole documents.
SEGMENT_IDS = 1 << 19
#: Pieces whose ids a Python worker remembers (some 200 bytes each) before it starts afresh.
REMEMBERED = 600_000

_LETTER, _NUMBER, _OTHER, _SPACE, _UNSURE = range(5)
_WHITE = {*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
_workers: dict[int, Encoder] = {}


def _classes() -> np.ndarray:
    """Character classes of the cutting pattern, where they have been stable through Unicode's versions."""
    kinds = np.full(0x110000, _UNSURE, np.uint8)
    for code in itertools.chain(range(0x0500), range(0x2000, 0x2065), range(0x20A0, 0x20B6)):
        kind = unicodedata.category(chr(code))[0]
        if code in _WHITE:
            kinds[code] = _SPACE
        elif kind != "C" or code < 0x0100:
            kinds[code] = {"L": _LETTER, "N": _NUMBER}.get(kind, _OTHER)
    return kinds


def _byte_signs() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = itertools.count(0x100)
    return {byte: chr(byte if byte in printable else next(others)) for byte in range(0x100)}


_BYTE_SIGNS = _byte_signs()


class Encoder:
    """Encodes batches of texts with one vocabulary file's content."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(vocabulary)
        self.model.no_padding()
        self.model.no_truncation()
        spec = json.loads(vocabulary)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        cutter = spec.get("pre_tokenizer") or {}
        #: Only the plain byte-level form is cut here; any other vocabulary goes through the library text by text.
        self.byte_level = (
            cutter.get("type") == "ByteLevel"
            and not cutter.get("add_prefix_space")
            and cutter.get("use_regex", True)
            and not spec.get("normalizer")
            and not spec["model"].get("dropout")
        )
        self.classes = _classes()
        self.known: dict[bytes, bytes] = {}
        self.words = self.model.model

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, new: list[bytes]) -> None:
        """Encode pieces by the library's model: each is one word to it, so nothing is cut or aligned again."""
        words = [[token.id for token in self.words.tokenize(w.decode("latin-1").translate(_BYTE_SIGNS))] for w in new]
        raw = np.fromiter(itertools.chain.from_iterable(words), np.uint32).tobytes()
        ends = np.cumsum([0, *map(len, words)]) * 4
        self.known.update((w, raw[i:j]) for w, i, j in zip(new, ends[:-1].tolist(), ends[1:].tolist()))

    def _cuts(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where pieces begin: contractions, then an optional blank with letters, digits or signs, then white space."""
        n = len(codes)
        kind = self.classes[codes]
        opens = np.zeros(n + 1, bool)
        opens[bounds] = True
        head = opens[:n].copy()  # first characters of texts
        before = np.full(n, _UNSURE, np.uint8)
        before[1:] = kind[:-1]
        before[head] = _UNSURE
        opens[:n] |= kind != before
        last = np.ones(n, bool)  # last of its text
        last[:-1] = head[1:]
        white = kind == _SPACE
        ends_run = np.zeros(n, bool)  # last blank before something else in the same text
        ends_run[:-1] = white[:-1] & ~white[1:]
        ends_run &= ~last
        opens[:n] |= ends_run
        joins = np.flatnonzero(ends_run & (codes == 0x20)) + 1
        opens[joins] = False
        blank_before = np.zeros(n, bool)
        blank_before[joins] = True
        quote = np.flatnonzero((codes == 0x27) & (before != _OTHER) & ~blank_before & ~last)
        if len(quote):
            follow = codes[quote + 1]
            second = np.where(quote + 2 < n, codes[np.minimum(quote + 2, n - 1)], 0)
            second[last[quote + 1]] = 0
            one = np.isin(follow, [ord(c) for c in "stmd"])
            two = np.zeros(len(quote), bool)
            for a, b in ("re", "ve", "ll"):
                two |= (follow == ord(a)) & (second == ord(b))
            for found, size in ((one, 2), (two, 3)):
                at = quote[found]
                opens[at + 1] = False
                opens[at + size] = True
        opens[n] = False
        return np.flatnonzero(opens)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and each text's number of ids."""
        data, offsets = text_bytes(texts)
        n = len(offsets) - 1
        whole = data.tobytes().decode()
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        place = np.flatnonzero((data & 0xC0) != 0x80)
        bounds = np.searchsorted(place, offsets)
        odd = np.zeros(n, bool)
        if not self.byte_level:
            odd[:] = True
        unsure = np.flatnonzero(self.classes[codes] == _UNSURE)
        odd[np.searchsorted(bounds, unsure, "right") - 1] = True
        for special in self.special:
            at = whole.find(special)
            while at >= 0:
                odd[np.searchsorted(bounds, at, "right") - 1] = True
                at = whole.find(special, at + 1)
        cuts = self._cuts(codes, bounds) if len(codes) else np.zeros(0, np.int64)
        row = np.searchsorted(bounds, cuts, "right") - 1
        at = np.append(place[cuts], len(data)) if len(cuts) else np.zeros(1, np.int64)
        cut = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(cuts), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)]
        )
        if odd.any():
            keep = ~odd[row]
            cut, row = cut.filter(pa.array(keep)), row[keep]
        coded = cut.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [w for w in distinct if w not in self.known]
        if new:
            self._learn(new)
        lists = [self.known[w] for w in distinct]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        flat = np.frombuffer(b"".join(lists), np.uint32)
        index = coded.indices.to_numpy()
        each = sizes[index]
        begin = (np.cumsum(sizes) - sizes)[index]
        ids = flat[np.repeat(begin - (np.cumsum(each) - each), each) + np.arange(each.sum())]
        counts = np.bincount(row, weights=each, minlength=n).astype(np.int64) if len(row) else np.zeros(n, np.int64)
        if not odd.any():
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1])
        rows = np.flatnonzero(odd)
        for i, own in zip(rows, self._whole([whole[bounds[i] : bounds[i + 1]] for i in rows])):
            parts[i] = np.array(own, np.uint32)
        return np.concatenate(parts).astype(np.uint32), np.array([len(p) for p in parts], np.int64)


def _encoder(vocabulary: Broadcast) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    text = vocabulary.value
    key = hash(text)
    if key not in _workers:
        _workers.clear()
        _workers[key] = Encoder(text)
    return _workers[key]


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int | None = END_ID) -> None:
    """Write the ids of all rows of ``docs`` in ascending doc_id order (nulls first; equal ids by a hash of their text).

    ``vocabulary``: a tokenizers file on the driver; its content (one file, a few MB) is sent to the executors. Null is an
    empty text; every document ends with ``end_id``. Rows are kept one for one; no other column is read. Texts are shuffled
    once, into ranges of doc_id, and encoded where they arrive: the range bounds are sampled from the table itself.
    """
    with open(vocabulary, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("tie", F.xxhash64("text"))
    ranged = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    tail = np.array([] if end_id is None else [end_id], np.uint32)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        ids_held, docs_held, counts_held, held, before, number = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            row = {
                "shard": pa.array([shard], pa.int32()),
                "segment": pa.array([number], pa.int64()),
                "shard_start": pa.array([before], pa.int64()),
                "doc_ids": pa.array([docs_held], pa.list_(pa.int64())),
                "doc_tokens": pa.array([np.concatenate(counts_held)], pa.list_(pa.int64())),
                "payload": pa.array([pack(np.concatenate(ids_held))], pa.binary()),
            }
            return pa.record_batch(row)

        for batch in pieces(batches):
            ids, counts = _encoder(content).encode(batch.column("text"))
            if len(tail):
                ids = np.insert(ids, np.repeat(np.cumsum(counts), len(tail)), np.tile(tail, len(counts)))
            ids_held.append(ids)
            docs_held += batch.column("doc_id").to_pylist()
            counts_held.append(counts + len(tail))
            held += len(ids)
            if held >= SEGMENT_IDS:
                yield close()
                before, number = before + held, number + 1
                ids_held, docs_held, counts_held, held = [], [], [], 0
        if docs_held:
            yield close()

    schema = "shard int, segment long, shard_start long, doc_ids array<long>, doc_tokens array<long>, payload binary"
    ranged.select("doc_id", "text").mapInArrow(segments, schema).write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document, decoded from the files: ``doc_id``, ``start`` (ids before it), ``n_tokens``, ``ids`` (array)."""
    return _decoded(spark, path, "doc_id long, start long, n_tokens long, ids array<long>", lambda ids: ids.astype(np.int64))


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start``, ``n_tokens`` and the crc32 of its ids as uint32 words."""
    return _decoded(
        spark, path, "doc_id long, start long, n_tokens long, ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes())
    )


def _decoded(spark: SparkSession, path: str, schema: str, value) -> DataFrame:
    stored = spark.read.parquet(path)
    totals = stored.groupBy("shard").agg(F.sum(F.aggregate("doc_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard, that is per write task, whatever the data's size; this is what is broadcast.
    base = totals.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    name = schema.rpartition(" ")[0].rpartition(" ")[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                ids = unpack(row["payload"].as_buffer().to_pybytes())
                sizes = np.array(row["doc_tokens"].as_py(), np.int64)
                ends = np.cumsum(sizes)
                start = ends - sizes
                cells = [value(ids[a:b]) for a, b in zip(start, ends)]
                out = {
                    "doc_id": row["doc_ids"].values,
                    "start": pa.array(start + row["base"].as_py() + row["shard_start"].as_py()),
                    "n_tokens": pa.array(sizes),
                    name: pa.array(cells, pa.list_(pa.int64()) if "array" in schema else pa.int64()),
                }
                yield pa.record_batch(out)

    joined = stored.join(F.broadcast(base), "shard")
    return joined.select("shard_start", "doc_ids", "doc_tokens", "payload", "base").mapInArrow(run, schema)
