"""Cutting whole Arrow batches of text into words with numpy, byte by byte.

All word patterns used here are about ASCII only, so every byte above 0x7F belongs to a word and UTF-8 needs no decoding.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing: digits, a-z and everything beyond ASCII.
ALNUM = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
#: ``[^\x20\x09-\x0D]+``: everything but white space.
NON_SPACE = np.array([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
_MIX = np.uint64(0x9E3779B97F4A7C15)

#: Bytes of text that are worked on at a time; a longer text is a piece of its own.
PIECE_BYTES = 4 << 20


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins (one more entry: the end). Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) else "")
    wide = texts.cast(pa.large_binary())
    _, at, data = wide.buffers()
    offsets = np.frombuffer(at, np.int64)[wide.offset : wide.offset + len(wide) + 1] if at else np.zeros(1, np.int64)
    if data is None or not len(wide):
        return np.zeros(0, np.uint8), np.zeros(len(wide) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each holds about ``limit`` bytes of text, so that a task's memory is bounded."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        row = 0
        while row < batch.num_rows:
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
            yield batch.slice(row, end - row)
            row = end


@dataclass
class Words:
    """The words of some texts: byte ranges, the text of each, and each text's first word (one more entry: the end)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    @property
    def place(self) -> np.ndarray:
        """Each word's number within its text, from 0."""
        return np.arange(len(self.starts)) - np.repeat(self.first[:-1], self.counts)

    def values(self) -> pa.Array:
        lengths = self.ends - self.starts
        at = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths, out=at[1:])
        index = np.repeat(self.starts - at[:-1], lengths) + np.arange(at[-1])
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(lengths), [None, pa.py_buffer(at), pa.py_buffer(self.data[index])]
        )

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words, alike on every machine: a polynomial over the bytes, then mixed."""
        return hash_ranges(self.data, self.starts, self.ends)


def cut(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    """Maximal runs of word bytes; a word never crosses from one text to the next."""
    size = len(data)
    inside = np.zeros(size + 1, np.int8)
    inside[:size] = is_word[data]
    begins = inside.copy()
    begins[1:] &= 1 - inside[:-1]
    closes = inside.copy()
    closes[:-1] &= 1 - inside[1:]
    bounds = offsets[(offsets > 0) & (offsets < size)]
    begins[bounds] = inside[bounds]
    closes[bounds - 1] = inside[bounds - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, by doubling."""
    out = np.ones(max(1, n), np.uint64)
    done, step = 1, np.uint64(base)
    with np.errstate(over="ignore"):
        while done < n:
            m = min(done, n - done)
            out[done : done + m] = out[:m] * step
            done, step = done + m, step * step
    return out[:n]


_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges from one prefix sum: equal bytes give equal hashes, wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(mix(data.astype(np.uint64) + _MIX) * powers(_BASE, len(data)), out=prefix[1:])
        value = (prefix[ends] - prefix[starts]) * powers(_INVERSE, len(data) + 1)[starts]
        return mix(value + (ends - starts).astype(np.uint64) * _MIX)


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ragged rows of the given lengths: each entry's row, and its place in the row."""
    row = np.repeat(np.arange(len(counts)), counts)
    start = np.cumsum(counts) - counts
    return row, np.arange(len(row)) - np.repeat(start, counts)


def give_back() -> None:
    """Return memory that is free inside this process to the machine, so that idle Python workers hold little."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
