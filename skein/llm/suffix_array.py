"""Suffix arrays by induced sorting, and permuted common prefixes, vectorised with numpy.

The classic algorithm scans the array once for each pass.  Here a pass walks over buckets (first
symbols) and treats a whole bucket at a time, so it costs a few array operations a bucket and a
constant amount of work a suffix.  The recursion keeps buckets few: names of leftmost-smaller
substrings are written with two digits when there are many.
"""

from __future__ import annotations

import numpy as np

#: More symbols than this are written as two digits.
MAX_SYMBOLS = 3000
#: Strings of names up to this length end the recursion: they are sorted by doubling.
SMALL = 300_000
#: Suffix pairs that are compared at once.
CHUNK = 200_000


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of an integer array (values >= 0, fewer than 2^31) in ascending order."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    values = np.flatnonzero(np.bincount(text)) if text.dtype.itemsize <= 2 else np.unique(text)
    kind = np.uint16 if len(values) < 65000 else np.int32
    if values[0] >= 0 and values[-1] < 4096:  # a small alphabet is renamed by a table
        table = np.zeros(int(values[-1]) + 1, kind)
        table[values] = np.arange(1, len(values) + 1)
        t = np.append(table[text], kind(0))
    else:
        t = np.append((np.searchsorted(values, text) + 1).astype(kind), kind(0))
    return _sort(t, len(values) + 1)[1:]


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour."""
    n = len(t)
    less = np.empty(n, bool)
    less[-1] = True
    d = (t[1:] > t[:-1]).astype(np.int8) - (t[1:] < t[:-1])
    at = np.where(d != 0, np.arange(n - 1, dtype=np.int32), np.int32(n - 1))  # an equal neighbour inherits: find the next unequal one
    at = np.minimum.accumulate(at[::-1])[::-1]
    known = np.append(d, 1)[at]
    less[:-1] = known > 0
    return less


def _sort(t: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of ``t``, which ends in the only 0; symbols are below ``k``."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    small = _types(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    ends = np.cumsum(np.bincount(t, minlength=k))
    starts = ends - np.bincount(t, minlength=k)
    sa = _induce(t, k, small, lms, starts, ends)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]
    m = len(lms)
    if m > 1:
        new = _differs(t, order, lms)
        names = np.cumsum(new, dtype=np.int32) - 1
        if names[-1] + 1 < m:
            at = np.empty(n, np.int32)
            at[order] = names
            order = lms[_reduced(at[lms], int(names[-1]) + 1)]
    return _induce(t, k, small, order, starts, ends)


def _reduced(names: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of the string of names, which ends in its only 0 (the final sentinel)."""
    if len(names) <= SMALL:
        return _doubled(names)
    if k <= MAX_SYMBOLS:
        return _sort(names.astype(np.uint16), k)
    base = int(np.ceil(np.sqrt(k))) + 1
    body = names[:-1]
    digits = np.empty(2 * len(body) + 1, np.uint16 if base < 65000 else np.int64)
    digits[0:-1:2] = body // base + 1
    digits[1:-1:2] = body % base + 1
    digits[-1] = 0
    sa = _sort(digits, base + 2)
    even = sa[1:][sa[1:] % 2 == 0] // 2
    return np.concatenate([[len(body)], even])


def _doubled(names: np.ndarray) -> np.ndarray:
    """Suffix array of a short string: ranks by the first 1, 2, 4, ... names until all differ."""
    n = len(names)
    rank, step = names.astype(np.int64), 1
    while True:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        by = key[order]
        new = np.concatenate([[0], np.cumsum(by[1:] != by[:-1])])
        rank[order] = new
        if new[-1] == n - 1 or step >= n:
            return order
        step *= 2


def _differs(t: np.ndarray, order: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """For leftmost-smaller substrings in sorted order: does each differ from the one before it?"""
    n = len(t)
    after = np.empty(n, np.int32)
    after[lms[:-1]] = lms[1:]
    after[lms[-1]] = n - 1
    size = after[order] - order + 1
    new = np.ones(len(order), bool)
    a, b = order[:-1], order[1:]
    live = np.flatnonzero(size[:-1] == size[1:])
    step = 0
    while len(live):
        same = t[a[live] + step] == t[b[live] + step]
        live = live[same]
        step += 1
        done = size[:-1][live] == step
        new[live[done] + 1] = False
        live = live[~done]
    return new


def _induce(t: np.ndarray, k: int, small: np.ndarray, lms: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffix order induced from leftmost-smaller suffixes, given in order within their buckets."""
    n = len(t)
    sa = np.zeros(n, np.int32)
    lms = lms.astype(np.int32)
    first = t[lms]
    by = np.argsort(first, kind="stable")
    seeds, cuts = lms[by], np.concatenate([[0], np.cumsum(np.bincount(first, minlength=k))])
    head = starts.copy()
    large = ~small
    inner = small.copy()
    inner[-1] = False  # the sentinel has no right neighbour: -1 must find nothing here

    def push_large(block: np.ndarray) -> None:
        j = block - 1  # -1, of the text's start, reads the sentinel, which is small
        j = j[large[j]]
        if not len(j):
            return
        c = t[j]
        o = c.argsort(kind="stable")
        c, j = c[o], j[o]
        edge = np.empty(len(c), bool)
        edge[0] = True
        np.not_equal(c[1:], c[:-1], out=edge[1:])
        cut = edge.nonzero()[0]
        size = np.empty_like(cut)
        size[:-1] = cut[1:] - cut[:-1]
        size[-1] = len(c) - cut[-1]
        sym = c[cut].astype(np.int64)
        sa[np.repeat((head[sym] - cut).astype(np.int32), size) + np.arange(len(c), dtype=np.int32)] = j
        head[sym] += size

    for c in range(k):
        lo = starts[c]
        while lo < head[c]:
            hi = head[c]
            push_large(sa[lo:hi])
            lo = hi
        if cuts[c] < cuts[c + 1]:
            push_large(seeds[cuts[c] : cuts[c + 1]])
    tail = ends.copy()

    def push_small(block: np.ndarray) -> None:
        j = block - 1
        j = j[inner[j]]
        if not len(j):
            return
        c = t[j]
        o = c.argsort(kind="stable")
        c, j = c[o], j[o]
        edge = np.empty(len(c), bool)
        edge[0] = True
        np.not_equal(c[1:], c[:-1], out=edge[1:])
        cut = edge.nonzero()[0]
        size = np.empty_like(cut)
        size[:-1] = cut[1:] - cut[:-1]
        size[-1] = len(c) - cut[-1]
        sym = c[cut].astype(np.int64)
        sa[np.repeat((tail[sym] - 1 + cut).astype(np.int32), size) - np.arange(len(c), dtype=np.int32)] = j
        tail[sym] -= size

    sa[0] = n - 1
    tail[0] = 0
    for c in range(k - 1, 0, -1):
        hi = ends[c]
        while hi > tail[c]:
            lo = tail[c]
            push_small(sa[lo:hi][::-1])
            hi = lo
        if starts[c] < head[c]:
            push_small(sa[starts[c] : head[c]][::-1])
    return sa


def permuted_lcp(text: np.ndarray, sa: np.ndarray, breaks: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(PLCP, Phi) of a byte array: common prefix of each suffix with the one before it in the order.

    Only irreducible positions - where the preceding symbols differ - and those at ``breaks`` are
    compared; all others follow, as the common prefix falls by one a step.  Values are right up to
    ``most``, counted from the last compared position.
    """
    n = len(text)
    phi = np.full(n, -1, np.int32)
    phi[sa[1:]] = sa[:-1]
    if n < 2:
        return np.zeros(n, np.int32), phi
    pad = np.concatenate([text.astype(np.uint8), np.zeros(most + 16, np.uint8)])
    words = np.lib.stride_tricks.as_strided(pad.view(np.uint8), shape=(len(pad) - 7, 8), strides=(1, 1))
    same = np.zeros(n, bool)
    same[1:] = (phi[1:] > 0) & (text[:-1] == pad[phi[1:] - 1])
    same[breaks] = False
    todo = np.flatnonzero(~same & (phi >= 0)).astype(np.int32)
    reach = np.full(n, -1, np.int32)
    for k in range(0, len(todo), CHUNK):
        part = todo[k : k + CHUNK]
        reach[part] = part + _compare(words, part, phi[part], n, most)
    at = np.arange(n, dtype=np.int32)
    last = np.maximum.accumulate(np.where(reach >= 0, at, 0))
    plcp = np.maximum(reach[last] - at, 0)
    plcp[phi < 0] = 0
    return plcp, phi


def _compare(words: np.ndarray, a: np.ndarray, b: np.ndarray, n: int, most: int) -> np.ndarray:
    """Common prefix of the suffixes at ``a`` and ``b``, eight bytes a step, up to ``most`` or a little more."""
    got = np.zeros(len(a), np.int32)
    live = np.arange(len(a))
    step = 0
    while len(live) and step < most:
        x, y = a[live] + step, b[live] + step
        diff = words[np.minimum(x, n + 8)] != words[np.minimum(y, n + 8)]
        length = np.where(diff.any(1), diff.argmax(1), 8)
        length = np.maximum(np.minimum(length, np.minimum(n - x, n - y)), 0)
        got[live] += length.astype(np.int32)
        live = live[length == 8]
        step += 8
    return got
