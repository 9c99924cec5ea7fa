"""Block-Max MaxScore over one shard of an inverted index, with numpy.

A term's postings (document number in the shard, term frequency) are cut into blocks of ``BLOCK``; a block knows its
first and last document, the largest impact in it, and where its bytes lie. Its documents are stored as differences
to the first one, in as few bytes each as the largest difference needs, its frequencies likewise.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64
FIRST_WINDOW = 512     # documents looked at first; the window then doubles
MOST_WINDOW = 8192


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 8 * m)


def _width(x: np.ndarray) -> np.ndarray:
    return np.where(x < 1 << 8, 1, np.where(x < 1 << 16, 2, 4))


def _put(out: np.ndarray, at: np.ndarray, values: np.ndarray, width: np.ndarray) -> None:
    for k in range(4):
        here = width > k
        out[at[here] + k] = (values[here] >> (8 * k)) & 255


def _take(data: np.ndarray, at: np.ndarray, width: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at), np.int64)
    for k in range(4):
        here = width > k
        if not here.any():
            break
        out[here] |= data[at[here] + k].astype(np.int64) << (8 * k)
    return out


class Postings:
    """Blocks of postings: ``start`` (first block of every term and the total), per block ``first``, ``last``,
    ``best`` (largest impact), ``count``, ``offset``, ``width`` (bytes of a document + 8 * bytes of a frequency), and
    the bytes ``data``; ``m``: the length figure of every document."""

    FIELDS = (("start", np.int32), ("first", np.int32), ("last", np.int32), ("best", np.int32), ("count", np.uint8),
              ("offset", np.int64), ("width", np.uint8), ("data", np.uint8), ("m", np.int64))

    def __init__(self, **fields):
        for name, _ in self.FIELDS:
            setattr(self, name, fields[name])
        self.read = 0   # blocks decompressed so far

    @classmethod
    def build(cls, term: np.ndarray, doc: np.ndarray, tf: np.ndarray, n_terms: int, m: np.ndarray) -> "Postings":
        """From postings in order of (term, doc)."""
        df = np.bincount(term, minlength=n_terms)
        begin = np.cumsum(df) - df
        blocks = -(-df // BLOCK)
        start = np.zeros(n_terms + 1, np.int64)
        np.cumsum(blocks, out=start[1:])
        nth = np.arange(len(term)) - begin[term]
        block = start[term] + nth // BLOCK
        head = np.flatnonzero(nth % BLOCK == 0)
        tail = np.append(head[1:], len(term)) - 1 if len(head) else head
        count = tail - head + 1
        first, last = doc[head], doc[tail]
        best = np.maximum.reduceat(impact(tf, m[doc]), head) if len(head) else head
        wd = _width(last - first)
        wt = _width(np.maximum.reduceat(tf, head)) if len(head) else head
        size = count * (wd + wt)
        offset = np.cumsum(size) - size
        data = np.zeros(int(size.sum()), np.uint8)
        inside = nth % BLOCK
        _put(data, offset[block] + inside * wd[block], doc - first[block], wd[block])
        _put(data, offset[block] + count[block] * wd[block] + inside * wt[block], tf, wt[block])
        made = {"start": start, "first": first, "last": last, "best": best, "count": count, "offset": offset,
                "width": wd + 8 * wt, "data": data, "m": m}
        return cls(**{name: made[name].astype(kind) for name, kind in cls.FIELDS})

    def dump(self) -> dict[str, bytes]:
        return {name: getattr(self, name).tobytes() for name, _ in self.FIELDS}

    @classmethod
    def load(cls, row: dict[str, bytes]) -> "Postings":
        return cls(**{name: np.frombuffer(row[name], kind) for name, kind in cls.FIELDS})

    def decode(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, impact, index in ``blocks``) of all postings of some blocks."""
        self.read += len(blocks)
        n = self.count[blocks].astype(np.int64)
        of = np.repeat(np.arange(len(blocks)), n)
        inside = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        wd, wt = (self.width[blocks] & 7).astype(np.int64), (self.width[blocks] >> 3).astype(np.int64)
        at = self.offset[blocks]
        doc = _take(self.data, at[of] + inside * wd[of], wd[of]) + self.first[blocks][of]
        tf = _take(self.data, (at + n * wd)[of] + inside * wt[of], wt[of])
        return doc, impact(tf, self.m[doc]), of


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the integers of all ranges [lo, hi), number of the range of each)."""
    n = hi - lo
    of = np.repeat(np.arange(len(lo)), n)
    return np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + lo[of], of


def best_documents(p: Postings, terms: np.ndarray, weight: np.ndarray, k: int, order: np.ndarray | None = None
                   ) -> tuple[np.ndarray, np.ndarray]:
    """(document, score) of the ``k`` documents with the highest scores above 0, highest first, among equals the one
    with the lower ``order`` (its number if not given). ``terms``: distinct terms of the query in this shard."""
    order = np.arange(len(p.m)) if order is None else order
    use = (weight > 0) & (p.start[terms + 1] > p.start[terms])
    terms, weight = terms[use], weight[use].astype(np.int64)
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(terms):
        return docs, scores
    lo, hi = p.start[terms].astype(np.int64), p.start[terms + 1].astype(np.int64)
    bound = np.array([p.best[a:b].max() for a, b in zip(lo, hi)], np.int64) * weight
    by = np.argsort(bound, kind="stable")
    lo, hi, bound, weight = lo[by], hi[by], bound[by], weight[by]
    up_to = np.cumsum(bound)                       # what the lists up to here can give together
    blocks, of = _ranges(lo, hi)                   # all blocks of the query, list after list
    first, last = p.first[blocks].astype(np.int64), p.last[blocks].astype(np.int64)
    cap = p.best[blocks] * weight[of]
    step = len(p.m) + 1
    key = of * step + last                         # ascending: one search finds the block of a document in any list
    floor = 0                                      # the k-th best score so far
    a, size = 0, FIRST_WINDOW
    while a < len(p.m):
        b = min(len(p.m), a + size)
        size = min(MOST_WINDOW, 2 * size)
        rest = int(np.searchsorted(up_to, floor, "left"))   # lists that can't reach the floor even together
        here = np.flatnonzero((of >= rest) & (last >= a) & (first < b))
        doc, q, i = p.decode(blocks[here])
        inside = (doc >= a) & (doc < b)
        got = np.bincount(doc[inside] - a, q[inside] * weight[of[here[i[inside]]]].astype(float), b - a).astype(np.int64)
        cand = np.flatnonzero(got)
        part = got[cand]
        cand += a
        if rest:
            near = part + up_to[rest - 1] >= floor
            cand, part = cand[near], part[near]
            lists = np.arange(rest)
            where = np.searchsorted(key, (lists * step)[:, None] + cand[None, :])   # the block that may hold it
            where = np.minimum(where, len(key) - 1)
            hold = (of[where] == lists[:, None]) & (first[where] <= cand[None, :])
            most = np.where(hold, cap[where], 0)
            left = np.cumsum(most, axis=0)         # by block maxima: lists up to here
            for j in range(rest - 1, -1, -1):      # the lists with most to give first
                alive = part + left[j] >= floor
                cand, part, left, where, hold = (cand[alive], part[alive], left[:, alive], where[:, alive], hold[:, alive])
                if not len(cand):
                    break
                wanted = np.unique(where[j][hold[j]])
                if not len(wanted):
                    continue
                doc, q, _ = p.decode(blocks[wanted])
                at = np.minimum(np.searchsorted(doc, cand), len(doc) - 1)
                part = part + np.where(doc[at] == cand, q[at] * weight[j], 0)
        if len(cand):
            docs, scores = np.concatenate([docs, cand]), np.concatenate([scores, part])
            top = np.lexsort((order[docs], -scores))[:k]
            docs, scores = docs[top], scores[top]
            if len(docs) == k:
                floor = int(scores[-1])
        a = b
    return docs, scores
