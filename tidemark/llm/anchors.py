"""Anchors of texts: positions chosen by content, so that equal strings have equal anchors wherever they stand."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tidemark.llm.words import mix, powers

_BASE = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOW = np.uint64((1 << 32) - 1)  # bits of a key that hold the place; the rest are the gram's


_powers: dict[int, np.ndarray] = {}


def _first_powers(base: int, n: int) -> np.ndarray:
    """Powers kept from buffer to buffer."""
    if len(_powers.get(base, ())) < n:
        _powers[base] = powers(base, n + n // 4)
    return _powers[base][:n]


class Hasher:
    """Hashes of byte ranges of one buffer; equal bytes give equal hashes in every buffer."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        with np.errstate(over="ignore"):
            self.prefix = np.zeros(n + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _first_powers(_BASE, n), out=self.prefix[1:])
            self.back = _first_powers(_INVERSE, n + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            value = (self.prefix[ends] - self.prefix[starts]) * self.back[starts]
            return mix(value ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))

    def grams(self, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.prefix[size:] - self.prefix[:-size]) * self.back[: len(self.prefix) - size])


@dataclass
class Anchors:
    """Where anchors begin, the text of each, and the hash of each one's gram."""

    at: np.ndarray
    doc: np.ndarray
    gram: np.ndarray


def anchors(hasher: Hasher, offsets: np.ndarray, gram: int, window: int) -> Anchors:
    """The least gram of each ``window`` bytes of each text (of the first of equal ones), once each.

    Every string of ``window`` bytes thus holds an anchor, and equal strings hold the same ones at the same places.
    The buffer must be below 4 GB.
    """
    spans = window - gram + 1
    n_grams = len(hasher.prefix) - gram
    if n_grams < spans:
        return Anchors(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    value = hasher.grams(gram)
    key = (value & ~_LOW) | np.arange(n_grams, dtype=np.uint64)
    # Least of each run of ``spans`` keys: from the left inside blocks of that size, and from the right.
    padded = np.full(-(-n_grams // spans) * spans, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n_grams] = key
    blocks = padded.reshape(-1, spans)
    left = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    n_windows = n_grams - spans + 1
    least = np.minimum(right[:n_windows], left[spans - 1 : spans - 1 + n_windows])
    inside = np.zeros(len(hasher.prefix), np.int32)  # windows that stay within one text
    long = np.flatnonzero(np.diff(offsets) >= window)
    np.add.at(inside, offsets[long], 1)
    np.add.at(inside, offsets[long + 1] - window + 1, -1)
    use = np.cumsum(inside)[:n_windows] > 0
    chosen = least[use]
    if not len(chosen):
        return Anchors(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    at = np.unique((chosen & _LOW).astype(np.int64))
    return Anchors(at, np.searchsorted(offsets, at, "right") - 1, value[at])
