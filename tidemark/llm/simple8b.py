"""Simple-8b: a varying count of whole numbers in each 64-bit word, coded and decoded a block of words at a time.

A word's top four bits select how many numbers share the other 60 bits. Selector 0 is an escape: the word holds the place
of a number of 60 bits or more in a list of escapes kept beside the words. Numbers are cut into blocks of ``BLOCK``; where
each block's words begin is kept too, so that any block can be decoded without those before it.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 4096
#: Selectors 1 to 14: numbers in a word. A number has 60 // count bits.
COUNTS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
WIDTHS = tuple(60 // n for n in COUNTS)
_COUNT = np.array((1, *COUNTS, 0), np.int64)
_PAD = COUNTS[-1]
_LIMITS = np.array([1 << w for w in WIDTHS[::-1]], np.uint64)
_SMALL = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), "right").astype(np.uint8)
_HEAD = struct.Struct("<4sIQQII")
MAGIC = b"S8B1"


def _selectors(kind: np.ndarray) -> np.ndarray:
    """The largest selector that fits at each place; ``kind`` is the narrowest width that fits each number, from 0."""
    most: dict[int, np.ndarray] = {1: kind}

    def run(n: int, a: int, shift: int) -> None:  # maximum over n numbers from two runs of a
        x = most[a].copy()
        np.maximum(x[..., :-shift], most[a][..., shift:], out=x[..., :-shift])
        most[n] = x

    for n, a in ((2, 1), (3, 2), (4, 2), (5, 3), (6, 3), (7, 4), (8, 4), (10, 5), (12, 6), (15, 8), (20, 10), (30, 15), (60, 30)):
        run(n, a, n - a)
    fits = np.zeros(kind.shape, np.uint8)
    for i, n in enumerate(COUNTS):
        fits += most[n] <= len(COUNTS) - 1 - i
    return fits


def pack(numbers: np.ndarray) -> bytes:
    """A block file's bytes: head, first word of each block, escapes, words."""
    numbers = np.ascontiguousarray(numbers, np.uint64)
    n, n_blocks = len(numbers), -(-len(numbers) // BLOCK)
    grid = np.zeros((n_blocks, BLOCK + _PAD), np.uint64)
    body = np.zeros(n_blocks * BLOCK, np.uint64)
    body[:n] = numbers
    grid[:, :BLOCK] = body.reshape(n_blocks, BLOCK)
    if n and int(numbers.max()) < len(_SMALL):
        kind = _SMALL[grid]
    else:
        kind = np.searchsorted(_LIMITS, grid, "right").astype(np.uint8)  # len(COUNTS): an escape
    select = _selectors(kind)
    step = _COUNT[select]
    places: list[int] = []
    first = np.zeros(n_blocks + 1, np.uint32)
    for b in range(n_blocks):
        hop, p, end = step[b].tolist(), 0, min(BLOCK, n - b * BLOCK)
        base = b * (BLOCK + _PAD)
        while p < end:
            places.append(base + p)
            p += hop[p]
        first[b + 1] = len(places)
    at = np.array(places, np.int64)
    flat, chosen = grid.reshape(-1), select.reshape(-1)[at]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s, (count, width) in enumerate(zip(COUNTS, WIDTHS), 1):
        mine = np.flatnonzero(chosen == s)
        if len(mine):
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(width)
            words[mine] |= np.bitwise_or.reduce(flat[at[mine][:, None] + np.arange(count)] << shifts, axis=1)
    escaped = np.flatnonzero(chosen == 0)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64)
    head = _HEAD.pack(MAGIC, BLOCK, n, len(words), n_blocks, len(escaped))
    return b"".join((head, first.tobytes(), flat[at[escaped]].tobytes(), words.tobytes()))


def unpack(coded: bytes, blocks: tuple[int, int] | None = None) -> np.ndarray:
    """The numbers again; ``blocks`` (from, to) decodes these blocks alone."""
    magic, block, n, n_words, n_blocks, n_escapes = _HEAD.unpack_from(coded)
    if magic != MAGIC:
        raise ValueError("not a Simple-8b block file")
    at = _HEAD.size
    first = np.frombuffer(coded, np.uint32, n_blocks + 1, at).astype(np.int64)
    at += 4 * (n_blocks + 1)
    escapes = np.frombuffer(coded, np.uint64, n_escapes, at)
    at += 8 * n_escapes
    lo, hi = blocks or (0, n_blocks)
    words = np.frombuffer(coded, np.uint64, first[hi] - first[lo], at + 8 * first[lo])
    select = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNT[select]
    before = np.cumsum(counts) - counts
    opens = first[lo:hi] - first[lo]
    inner = before - np.repeat(before[opens], np.diff(first[lo : hi + 1]))
    target = np.repeat(np.arange(hi - lo) * (block + _PAD), np.diff(first[lo : hi + 1])) + inner
    out = np.zeros((hi - lo) * (block + _PAD), np.uint64)
    for s, (count, width) in enumerate(zip(COUNTS, WIDTHS), 1):
        mine = np.flatnonzero(select == s)
        if len(mine):
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(width)
            mask = np.uint64((1 << width) - 1)
            out[target[mine][:, None] + np.arange(count)] = (words[mine][:, None] >> shifts) & mask
    escaped = np.flatnonzero(select == 0)
    out[target[escaped]] = escapes[(words[escaped] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    whole = out.reshape(hi - lo, block + _PAD)[:, :block].reshape(-1)
    return whole[: n - lo * block] if hi == n_blocks else whole
