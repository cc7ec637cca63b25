"""Benchmark passages in training text, found with a positional inverted index that is spread over documents.

The index is a table of segments: one row holds the terms of some MB of documents, for each term the ascending places where
it stands, and the documents' ids and sizes. Places number the words of all documents of a segment, with a gap between
documents, so that no match crosses from one document to the next. Building it is one scan without a shuffle; so is searching it.

A search takes the benchmark's windows (n consecutive words of an item) in blocks. The block's terms are looked up in a segment
once, and only windows whose rarest term of the benchmark stands there are visited. Of those the rarest term in the segment
gives the candidates; the lists of its other terms, from rare to common and shifted by their offsets, are intersected
with them. Most windows end at once, as one of their terms is missing. With ``slack`` each word may stand that many places
away from its place: proximity matches, of which the exact phrases are those with 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.filters import unlisted
from tidemark.llm.words import ALNUM, Words, cut, give_back, lower_ascii, pieces, spread, text_bytes
from tidemark.session import work_path

WINDOW = 13
#: Words of benchmark items that one pass over the index searches for; more items take more passes.
BLOCK_WORDS = 500_000
#: Bytes of text to a segment; a longer document is one of its own.
SEGMENT = 2 << 20
#: Places left free between two documents; no slack of less than half of it can bridge them.
GAP = 64

INDEX = (
    "doc_ids array<long>, n_words array<long>, terms binary, term_ends binary, list_ends binary, places binary"
)


def words_of(texts: pa.Array) -> Words:
    data, offsets = text_bytes(texts)
    return cut(lower_ascii(data), offsets, ALNUM)


def build_index(docs: DataFrame, path: str) -> None:
    """Write the positional index of every word of ``docs`` (``doc_id``, ``text``; null has no words; no other column is read)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=SEGMENT):
            words = words_of(batch.column("text"))
            coded = words.values().dictionary_encode()
            term = coded.indices.to_numpy()
            place = (np.arange(len(term)) + words.doc * GAP).astype(np.uint32)
            by_term = np.argsort(term, kind="stable")  # each list's places stay ascending
            list_ends = np.cumsum(np.bincount(term, minlength=len(coded.dictionary))).astype(np.uint32)
            data, ends = text_bytes(coded.dictionary)
            places = place[by_term]
            gaps = np.diff(places, prepend=np.uint32(0))
            yield pa.record_batch(
                {
                    "doc_ids": pa.array([batch.column("doc_id")], pa.list_(pa.int64())),
                    "n_words": pa.array([words.counts], pa.list_(pa.int64())),
                    "terms": pa.array([data.tobytes()], pa.binary()),
                    "term_ends": pa.array([ends[1:].astype(np.uint32).tobytes()], pa.binary()),
                    "list_ends": pa.array([list_ends.tobytes()], pa.binary()),
                    "places": pa.array([gaps.tobytes()], pa.binary()),
                }
            )
        give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, INDEX)
    rows.write.option("compression", "zstd").parquet(path)


class Segment:
    """One row of the index, decoded."""

    def __init__(self, row: dict):
        self.doc_ids = row["doc_ids"].values
        self.n_words = np.array(row["n_words"].values, np.int64)
        raw = {c: row[c].as_buffer() for c in ("terms", "term_ends", "list_ends", "places")}
        ends = np.frombuffer(raw["term_ends"], np.uint32).astype(np.int64)
        at = np.append(0, ends)
        self.terms = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(ends), [None, pa.py_buffer(at), raw["terms"]]
        )
        self.list_ends = np.append(0, np.frombuffer(raw["list_ends"], np.uint32)).astype(np.int64)
        self.places = np.cumsum(np.frombuffer(raw["places"], np.uint32), dtype=np.uint32).astype(np.int64)
        self.doc_at = np.cumsum(self.n_words + GAP) - self.n_words - GAP

    def postings(self, term: int) -> np.ndarray:
        return self.places[self.list_ends[term] : self.list_ends[term + 1]]

    def find(self, terms: np.ndarray, slack: int = 0) -> np.ndarray:
        """Places where the window of these terms begins; with slack, where each term is near its place."""
        sizes = self.list_ends[terms + 1] - self.list_ends[terms]
        order = np.argsort(sizes, kind="stable")
        rarest = order[0]
        found = self.postings(terms[rarest]) - rarest
        for offset in order[1:]:
            if not len(found):
                break
            own = self.postings(terms[offset])
            at = np.searchsorted(own, found + offset - slack)
            found = found[(at < len(own)) & (own[np.minimum(at, len(own) - 1)] <= found + offset + slack)]
        return found


class Windows:
    """The different windows of some benchmark items and the items that hold each."""

    def __init__(self, items: list[tuple[object, str | None]], size: int):
        words = words_of(pa.array([t for _, t in items], pa.string()))
        coded = words.values().dictionary_encode()
        self.vocabulary, term = coded.dictionary, coded.indices.to_numpy()
        holders: dict[tuple[int, ...], set[str]] = {}
        for i, (item, _) in enumerate(items):
            own = term[words.first[i] : words.first[i + 1]].tolist()
            for k in range(max(1, len(own) - size + 1) if own else 0):
                holders.setdefault(tuple(own[k : k + size]), set()).add(str(item))
        self.items = [sorted(h) for h in holders.values()]
        lengths = np.array([len(w) for w in holders], np.int64)
        self.terms = np.full((len(holders), size), -1, np.int64)
        for i, w in enumerate(holders):
            self.terms[i, : len(w)] = w
        self.lengths = lengths
        # Windows by their term that fewest windows hold: where it is missing, they are not looked at.
        used = np.bincount(self.terms[self.terms >= 0], minlength=len(self.vocabulary) + 1)
        rarest = self.terms[np.arange(len(self.terms)), np.where(self.terms >= 0, used[self.terms], len(self.terms) * size + 1).argmin(1)]
        self.by_rarest = np.argsort(rarest, kind="stable")
        self.ends = np.append(0, np.cumsum(np.bincount(rarest, minlength=len(self.vocabulary))))

    def in_segment(self, segment: Segment) -> Iterator[tuple[int, np.ndarray]]:
        """The windows all of whose terms stand in the segment, as the segment's terms."""
        if not len(self.terms):
            return
        local = pa.compute.index_in(self.vocabulary, segment.terms).fill_null(-1).to_numpy()
        there = np.flatnonzero(local >= 0)
        row, place = spread(self.ends[there + 1] - self.ends[there])
        alive = self.by_rarest[self.ends[there][row] + place]
        for offset in range(self.terms.shape[1]):
            term = self.terms[alive, offset]
            alive = alive[(term < 0) | (local[term] >= 0)]
        for i in np.sort(alive).tolist():
            yield i, local[self.terms[i, : self.lengths[i]]]


HITS = "doc_id long, n_words long, spans array<struct<from:long,to:long>>, items array<string>"


def search(spark: SparkSession, path: str, items: DataFrame, window: int = WINDOW, slack: int = 0) -> DataFrame:
    """Per document of the index: its words, the word ranges that windows of ``items`` cover, and these items' ids as text.

    ``items``: ``item_id``, ``text``. An item of fewer than ``window`` words is one window; null or wordless items have none.
    Items with equal ids or texts are all reported. They are read block by block, each of ``BLOCK_WORDS`` words at most (a
    longer item is a block of its own), and each block is one pass over the stored index.
    """
    if not 0 <= slack < GAP // 2:
        raise ValueError(f"slack must be from 0 to {GAP // 2 - 1}")
    index = spark.read.parquet(path)
    passes = [_search(index, Windows(block, window), slack) for block in _blocks(items)]
    if len(passes) == 1:
        return passes[0]
    return _join_passes(passes)


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, str | None]]]:
    block, size = [], 0
    for item, text in items.select("item_id", "text").toLocalIterator():
        words = len(text or "") // 2 + 1
        if block and size + words > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += words
    yield block


def _search(index: DataFrame, windows: Windows, slack: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                segment = Segment({c: batch.column(c)[i] for c in batch.schema.names})
                starts, sizes, which = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for w, terms in windows.in_segment(segment):
                    found = segment.find(terms, slack)
                    if len(found):
                        starts.append(found)
                        sizes.append(np.full(len(found), len(terms)))
                        which.append(np.full(len(found), w))
                yield _hits(segment, np.concatenate(starts), np.concatenate(sizes), np.concatenate(which), windows, slack)
        give_back()

    return index.mapInArrow(run, HITS)


def _hits(
    segment: Segment, start: np.ndarray, size: np.ndarray, window: np.ndarray, windows: Windows, slack: int
) -> pa.RecordBatch:
    """Matches as one row per document: merged ranges, and the items."""
    n = len(segment.n_words)
    order = np.argsort(start, kind="stable")
    start, size, window = start[order], size[order], window[order]
    anchor = np.clip(start + (slack if slack else 0), 0, None)
    doc = np.searchsorted(segment.doc_at, anchor, "right") - 1
    low = np.maximum(start - slack, segment.doc_at[doc]) if len(doc) else start
    high = np.minimum(start + size + slack, segment.doc_at[doc] + segment.n_words[doc]) if len(doc) else start
    reach = np.maximum.accumulate(high) if len(high) else high
    opens = np.ones(len(start), bool)
    opens[1:] = low[1:] > reach[:-1]
    heads = np.flatnonzero(opens)
    lasts = np.append(heads[1:], len(start)) - 1 if len(heads) else heads
    head_doc = doc[heads]
    bounds = np.append(0, np.cumsum(np.bincount(head_doc, minlength=n))).astype(np.int32)
    spans = pa.StructArray.from_arrays(
        [pa.array(low[heads] - segment.doc_at[head_doc]), pa.array(reach[lasts] - segment.doc_at[head_doc])], ["from", "to"]
    )
    names: list[list[str]] = [[] for _ in range(n)]
    pairs = np.unique(np.stack([doc, window]), axis=1) if len(doc) else np.zeros((2, 0), np.int64)
    for d, w in pairs.T.tolist():
        names[d].extend(windows.items[w])
    return pa.record_batch(
        {
            "doc_id": segment.doc_ids,
            "n_words": pa.array(segment.n_words),
            "spans": pa.ListArray.from_arrays(pa.array(bounds), spans),
            "items": pa.array([sorted(set(x)) for x in names], pa.list_(pa.string())),
        }
    )


def _join_passes(passes: list[DataFrame]) -> DataFrame:
    """Several passes as one row per document: rows of a segment come in the same order in each pass."""
    tagged = [
        df.withColumn("row", F.monotonically_increasing_id()) for df in passes
    ]
    every = tagged[0]
    for df in tagged[1:]:
        every = every.unionByName(df)
    merged = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("spans"))),
        F.array().cast("array<struct<from:long,to:long>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["to"] >= x["from"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["from"].alias("from"),
                        F.greatest(F.element_at(done, -1)["to"], x["to"]).alias("to"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    return every.groupBy("row", "doc_id", "n_words").agg(
        merged.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    ).drop("row")


def phrase_matches(spark: SparkSession, path: str, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents that hold a window of an item word for word."""
    return search(spark, path, items, window).filter(F.size("items") > 0)


def proximity_matches(spark: SparkSession, path: str, items: DataFrame, window: int = WINDOW, slack: int = 2) -> DataFrame:
    """Documents that hold every word of a window within ``slack`` places of its place."""
    return search(spark, path, items, window, slack).filter(F.size("items") > 0)


def contamination(spark: SparkSession, path: str, items: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """Per document: words, words inside windows of items, these items, and whether at least 1 in ``share`` words is hit."""
    hits = search(spark, path, items, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not contaminated; ids may be null or repeated.

    Documents are told apart by a hash of their text. Only rows that may have to go are shuffled. Null and empty texts have no words and
    stay, copies go together, an empty table or an empty benchmark changes nothing.
    """
    path = work_path(docs.sparkSession, "decontaminate")
    build_index(docs.select(F.xxhash64("text").alias("doc_id"), "text"), f"{path}/index")
    hit = contamination(docs.sparkSession, f"{path}/index", items, window, share).filter("contaminated")
    hit.select(F.col("doc_id").alias("key")).distinct().write.parquet(f"{path}/hit")
    # The row is kept in a struct, so that no name among its columns can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.xxhash64("text").alias("key"))
    return unlisted(rows, "key", docs.sparkSession.read.parquet(f"{path}/hit")).select("doc.*")
