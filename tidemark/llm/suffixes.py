"""Suffix arrays by induced sorting, and common prefixes in text order, with numpy.

Induced sorting (Nong, Zhang and Chan, "Two efficient algorithms for linear time suffix array construction") is sequential by
nature, but within one bucket of the array everything that is already there can be induced from at once; a pass thus takes a few
array operations per bucket. The recursion on names goes on by doubling where names are so many that buckets would be tiny.
"""

from __future__ import annotations

import numpy as np

#: The recursion goes on by doubling if there are fewer symbols than this to a name.
DENSE = 24


def _types(t: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than the next one (S), False for larger ones (L); the last is S."""
    n = len(t)
    small = np.ones(n, bool)
    if n > 1:
        at = np.where(t[:-1] != t[1:], np.arange(n - 1), n - 2)
        nearest = np.minimum.accumulate(at[::-1])[::-1]
        small[:-1] = t[nearest] < t[nearest + 1]
    return small


def _grouped(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by symbol; the rank of each in its group; the groups and their sizes."""
    order = np.argsort(symbols, kind="stable")  # by digits, if symbols have 16 bits
    own = symbols[order]
    new = np.ones(len(own), bool)
    new[1:] = own[1:] != own[:-1]
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(own)))
    return order, np.arange(len(own)) - np.repeat(heads, sizes), own[heads], sizes


def _induce(t: np.ndarray, small: np.ndarray, seeds: np.ndarray, k: int) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in the order given."""
    n = len(t)
    if k <= 1 << 16:
        t = t.astype(np.uint16)
    counts = np.bincount(t, minlength=k)
    ends = np.cumsum(counts)
    starts = ends - counts
    n_large = np.bincount(t[~small], minlength=k)
    sa = np.full(n, -1, np.int32)
    order, rank, groups, sizes = _grouped(t[seeds])
    seed_at = ends.copy()
    seed_at[groups] -= sizes
    sa[np.repeat(seed_at[groups], sizes) + rank] = seeds[order]
    used = np.flatnonzero(counts).tolist()

    head = starts.copy()

    def push_large(batch: np.ndarray) -> None:
        j = batch - 1
        j = j[(batch > 0) & ~small[j]]
        if len(j):
            order, rank, groups, sizes = _grouped(t[j])
            sa[np.repeat(head[groups], sizes) + rank] = j[order]
            head[groups] += sizes

    for c in used:
        done = starts[c]
        while done < head[c]:
            upto = head[c]
            push_large(sa[done:upto])
            done = upto
        if seed_at[c] < ends[c]:
            push_large(sa[seed_at[c] : ends[c]])
            sa[seed_at[c] : ends[c]] = -1

    tail = ends.copy()

    def push_small(batch: np.ndarray) -> None:
        j = batch - 1
        j = j[(batch > 0) & small[j]]
        if len(j):
            order, rank, groups, sizes = _grouped(t[j])
            sa[np.repeat(tail[groups] - 1, sizes) - rank] = j[order]
            tail[groups] -= sizes

    sa[0] = n - 1  # the sentinel
    tail[t[n - 1]] -= 1
    for c in reversed(used):
        done = ends[c]
        while done > tail[c]:
            upto = tail[c]
            push_small(sa[upto:done][::-1])
            done = upto
        if n_large[c]:
            push_small(sa[starts[c] : starts[c] + n_large[c]][::-1])
    return sa


def _doubling(t: np.ndarray) -> np.ndarray:
    n, h, rank = len(t), 1, t.astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[: n - h] = rank[h:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key)  # equal keys get one name, in whatever order they come
        own = key[order]
        name = np.cumsum(np.append(0, own[1:] != own[:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = name
        if name[-1] == n - 1:
            return order.astype(np.int32)
        h *= 2


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """Places of the suffixes of ``t`` in ascending order. ``t``: whole numbers below ``k``, the last one the least and unique."""
    n = len(t)
    if n < 3:
        return np.arange(n - 1, -1, -1, dtype=np.int32)
    small = _types(t)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    sa = _induce(t, small, lms, k)
    ranked = sa[is_lms[sa]]
    # Leftmost-smaller substrings reach to the next one's first symbol; equal ones get one name.
    length = np.ones(n, np.int32)
    length[lms[:-1]] = np.diff(lms) + 1
    a, b = ranked[:-1], ranked[1:]
    same = length[a] == length[b]
    both = np.flatnonzero(same)
    size = length[a[both]].astype(np.int64)
    begin = np.cumsum(size) - size
    step = np.arange(size.sum()) - np.repeat(begin, size)
    unlike = t[np.repeat(a[both], size) + step] != t[np.repeat(b[both], size) + step]
    if len(both):
        same[both] = np.add.reduceat(unlike, begin) == 0
    name = np.append(0, np.cumsum(~same))
    names = np.empty(n, np.int64)
    names[ranked] = name
    shorter = names[lms]
    many = int(name[-1]) + 1
    if many == len(lms):
        order = np.argsort(shorter, kind="stable")
    elif len(lms) < DENSE * many:
        order = _doubling(shorter)
    else:
        order = suffix_array(shorter, many)
    return _induce(t, small, lms[order], k)


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray, cap: int, fresh: np.ndarray) -> np.ndarray:
    """For each place, how many symbols its suffix shares with the one before it in order, counted up to ``cap``.

    Where the symbols before both are alike, the value is one less than at the place before; only the others are compared, and
    the places in ``fresh``, so that no value hangs on one that was cut off at ``cap`` more than that far away.
    """
    n = len(t)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    own = np.ones(n, bool)
    has = np.flatnonzero(before > 0)
    has = has[has > 0]
    own[has] = t[has - 1] != t[before[has] - 1]
    own[fresh] = True
    at = np.flatnonzero(own)
    length = np.zeros(len(at), np.int32)
    active = np.flatnonzero(before[at] >= 0)
    i, j = at[active].astype(np.int64), before[at[active]].astype(np.int64)
    padded = np.append(t, -1)
    for step in range(cap):
        go = padded[np.minimum(i + step, n)] == padded[np.minimum(j + step, n)]
        go &= (i + step < n) & (j + step < n)
        if not go.all():
            active, i, j = active[go], i[go], j[go]
        if not len(active):
            break
        length[active] += 1
    source = np.maximum.accumulate(np.where(own, np.arange(n), 0))
    full = np.zeros(n, np.int32)
    full[at] = length
    return np.maximum(full[source] - (np.arange(n) - source), 0)
