"""Numpy helpers over Arrow string columns: word boundaries, 64-bit word and shingle hashes, in bounded pieces."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

PIECE = 1 << 21          # bytes hashed at once; only word hashes outlive a piece
_MULT = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1) from hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts or binaries one after another, offsets); a null is empty."""
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = column.cast(pa.large_binary() if binary else pa.large_string()).fill_null(b"" if binary else "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer text has a range of its own."""
    _, off = text_bytes(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, "right")) - 1)
        yield lo, hi
        lo = hi


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    space = np.zeros(256, bool)
    space[[32, *range(9, 14)]] = True
    byte = mix(np.arange(1, 257, dtype=np.uint64) * _MULT)
    base = 0xD6E8FEB86659FD93   # odd, so that it has an inverse
    up, down = (np.cumprod(np.full(PIECE + 1, b, np.uint64)) for b in (base, pow(base, -1, 1 << 64)))
    return space, byte, up, down


def _piece_words(raw: np.ndarray, starts_text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of a piece; ``starts_text``: positions at which a text starts."""
    space, byte, up, down = _tables()
    solid = ~space[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    first[starts_text[starts_text < len(raw)]] = solid[starts_text[starts_text < len(raw)]]
    after = np.zeros(len(raw) + 1, bool)   # after[i]: a word ends before i
    after[1:] = solid
    after[:-1][solid] &= first[solid]
    s, e = np.flatnonzero(first), np.flatnonzero(after)
    n = len(raw)
    if n > len(up):
        up = np.cumprod(np.full(n + 1, up[0], np.uint64))
        down = np.cumprod(np.full(n + 1, down[0], np.uint64))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(byte[raw] * up[:n], out=total[1:])
    return s, e, mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * _MULT)


def word_hashes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of the first word of every text and the total). Words are separated by
    U+0020 and U+0009..U+000D and by the ends of texts."""
    space = _tables()[0]
    starts, hashes = [], []
    lo, n = 0, len(raw)
    begins = off[:-1]
    while lo < n:
        hi = min(n, lo + PIECE)
        if hi < n:   # cut where a word can't be cut: at a space, or at the start of a text
            blank = np.flatnonzero(space[raw[lo:hi]])
            k = int(np.searchsorted(begins, hi, "right")) - 1
            cut = max(lo + int(blank[-1]) if len(blank) else lo, int(begins[k]))
            while cut <= lo:   # one word longer than a piece
                more = np.flatnonzero(space[raw[hi:hi + PIECE]])
                nxt = int(begins[k + 1]) if k + 1 < len(begins) else n
                cut = min(hi + int(more[0]) if len(more) else min(hi + PIECE, n), nxt)
                if len(more) or cut == n or cut == nxt:
                    break
                hi, cut = cut, lo
            hi = cut
        a, b = np.searchsorted(begins, lo, "left"), np.searchsorted(begins, hi, "left")
        s, _, h = _piece_words(raw[lo:hi], begins[a:b] - lo)
        starts.append(s + lo)
        hashes.append(h)
        lo = hi
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    s = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(s, off, "left")


def shingles(words: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of ``size`` words, index of the first one of every text and the total). A text of
    fewer words, but at least one, has a single shingle of them all."""
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    begin = np.zeros(len(first), np.int64)
    np.cumsum(count, out=begin[1:])
    at = np.repeat(first[:-1] - begin[:-1], count) + np.arange(begin[-1])
    last = np.repeat(first[1:], count)
    out = np.full(len(at), np.uint64(0x51ED270B))
    padded = np.append(words, np.uint64(0))
    for k in range(size):
        p = at + k
        w = np.where(p < last, padded[np.minimum(p, len(words))], np.uint64(0x2545F491))
        out = mix(out * _MULT + w)
    return out, begin
