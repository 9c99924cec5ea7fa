"""Suffix arrays over sequences of integers, and the search of other sequences' suffixes in them."""

from __future__ import annotations

import numpy as np


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Positions of the non-zero values of ``seq`` (a zero follows every part, the last one too), ordered by the
    values from there to the next zero; equal ones in any order. Prefix doubling: after round r suffixes are in order
    of their first 2^r values, and only groups that still hold several unfinished suffixes are sorted again."""
    order = np.flatnonzero(seq).astype(np.int32)
    if not len(order):
        return order
    key = (seq[order].astype(np.int64) << 32) | seq[order + 1]
    by = np.argsort(key, kind="stable")
    order, key = order[by], key[by]
    rank = np.zeros(len(seq) + 1, np.int32)               # 0: ended
    where = np.arange(len(order), dtype=np.int32)         # slots of ``order`` that are to be sorted again
    ended = (key & 0xFFFFFFFF) == 0
    length = 2
    base = np.zeros(len(order), np.int32)
    while True:
        fresh = np.ones(len(where), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (base[1:] != base[:-1])
        head = np.maximum.accumulate(np.where(fresh, np.arange(len(where), dtype=np.int32), 0))
        rank[order[where]] = where[head] + 1
        last = np.append(fresh[1:], True)
        again = ~(fresh & last) & ~ended
        where = where[again]
        if not len(where):
            return order
        p = order[where]
        base = rank[p]
        key = rank[np.minimum(p + length, len(seq))]
        by = np.lexsort((key, base))
        order[where], key, base = p[by], key[by], base[by]
        ended = key == 0
        length *= 2


def _bisect(seq, sa, lo, hi, value, depth, right):
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        v = seq[np.minimum(sa[np.minimum(mid, len(sa) - 1)] + depth, len(seq) - 1)]   # closed ones may lie outside
        up = open_ & ((v <= value) if right else (v < value))
        lo = np.where(up, mid + 1, lo)
        hi = np.where(open_ & ~up, mid, hi)


def longest_matches(seq: np.ndarray, sa: np.ndarray, query: np.ndarray, asked: np.ndarray):
    """For every suffix of ``query`` (parts that end with a zero; a value that ``seq`` doesn't hold is negative) the
    longest prefix that occurs in ``seq``: (its length, range in ``sa`` [lo, hi) of the places; range of the places
    of its first ``asked`` values, empty if they don't occur). The range is narrowed by binary search value by value,
    for all suffixes at once."""
    m = len(query)
    length = np.zeros(m, np.int64)
    lo, hi = np.zeros(m, np.int64), np.full(m, len(sa), np.int64)
    wlo, whi = np.zeros(m, np.int64), np.zeros(m, np.int64)
    live = np.flatnonzero(query > 0)
    depth = 0
    while len(live):
        a, b, c = lo[live], hi[live], query[live + depth]
        x = _bisect(seq, sa, a, b, c, depth, False)
        y = _bisect(seq, sa, x, b, c, depth, True)
        found = x < y
        live, x, y = live[found], x[found], y[found]
        depth += 1
        lo[live], hi[live], length[live] = x, y, depth
        full = asked[live] == depth
        wlo[live[full]], whi[live[full]] = x[full], y[full]
        live = live[query[live + depth] > 0]
    return length, lo, hi, wlo, whi
