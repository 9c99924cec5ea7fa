"""Wavelet matrix of a sequence of token ids: one bit plane per bit of an id, with rank and select.

File format of one shard (little-endian): ``b"PWM1"``, levels (u32), number of ids (u64); then per level, highest bit
first: number of zeros (u64), rank directory (u32 ones before every block of 512 bits, one more for the end), and the
plane (bits packed, first bit highest). Plane l holds bit l of the ids in the order that level l - 1 left; zeros go
first, each half in its order.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 512
MAGIC = b"PWM1"


class WaveletMatrix:
    def __init__(self, n: int, zeros: list[int], directory: list[np.ndarray], planes: list[bytes]):
        self.n, self.zeros, self.directory, self.planes = n, zeros, directory, planes
        self.levels = len(planes)

    @classmethod
    def build(cls, ids: np.ndarray, levels: int | None = None) -> WaveletMatrix:
        need = int(ids.max()).bit_length() if len(ids) else 0
        levels = max(1, need if levels is None else max(levels, need))
        v = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        zeros, directory, planes = [], [], []
        for shift in range(levels - 1, -1, -1):
            bit = (v >> v.dtype.type(shift)) & v.dtype.type(1)
            one = bit.astype(bool)
            plane = np.packbits(one)
            padded = np.zeros(-(-len(plane) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
            padded[:len(plane)] = plane
            ones = np.bitwise_count(padded.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
            planes.append(plane.tobytes())
            directory.append(np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32))
            v = np.concatenate([v[~one], v[one]])
            zeros.append(len(ids) - int(directory[-1][-1]))
        return cls(len(ids), zeros, directory, planes)

    def to_bytes(self) -> bytes:
        out = [MAGIC, struct.pack("<IQ", self.levels, self.n)]
        for z, d, p in zip(self.zeros, self.directory, self.planes):
            out += [struct.pack("<Q", z), d.astype("<u4").tobytes(), p]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        levels, n = struct.unpack_from("<IQ", data, 4)
        at, blocks, size = 16, -(-(-(-n // 8)) // (BLOCK // 8)) + 1, -(-n // 8)
        zeros, directory, planes = [], [], []
        for _ in range(levels):
            zeros.append(struct.unpack_from("<Q", data, at)[0])
            directory.append(np.frombuffer(data, "<u4", blocks, at + 8))
            at += 8 + 4 * blocks
            planes.append(data[at:at + size])
            at += size
        return cls(n, zeros, directory, planes)

    def decode(self) -> np.ndarray:
        """All ids in order, from the lowest plane up."""
        v = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for l in range(self.levels - 1, -1, -1):
            one = np.unpackbits(np.frombuffer(self.planes[l], np.uint8), count=self.n).astype(bool)
            out = np.empty_like(v)
            out[~one] = v[:self.zeros[l]]
            out[one] = v[self.zeros[l]:] | v.dtype.type(1 << (self.levels - 1 - l))
            v = out
        return v.astype(np.uint32)

    def _ones(self, l: int, i: int) -> int:
        """Ones among the first ``i`` bits of plane ``l``."""
        b = i // BLOCK
        lo, hi = b * (BLOCK // 8), -(-i // 8)
        x = int.from_bytes(self.planes[l][lo:hi], "big") >> (hi * 8 - i)
        return int(self.directory[l][b]) + x.bit_count()

    def _at(self, l: int, k: int, bit: int) -> int:
        """Position of the ``k``-th (from 0) bit that is ``bit`` in plane ``l``."""
        d = self.directory[l]
        lo, hi = 0, len(d) - 1
        while hi - lo > 1:
            mid = (lo + hi) // 2
            before = int(d[mid]) if bit else mid * BLOCK - int(d[mid])
            lo, hi = (mid, hi) if before <= k else (lo, mid)
        before = int(d[lo]) if bit else lo * BLOCK - int(d[lo])
        block = np.unpackbits(np.frombuffer(self.planes[l][lo * (BLOCK // 8):(lo + 1) * (BLOCK // 8)], np.uint8))
        return lo * BLOCK + int(np.flatnonzero(block == bit)[k - before])

    def _select(self, l: int, k: np.ndarray, bit: int) -> np.ndarray:
        """``_at`` for many ``k``."""
        plane = np.zeros((len(self.directory[l]) - 1) * (BLOCK // 8), np.uint8)
        plane[:len(self.planes[l])] = np.frombuffer(self.planes[l], np.uint8)
        plane = plane.reshape(-1, BLOCK // 8)
        before = self.directory[l].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = np.minimum(np.searchsorted(before, k, "right") - 1, len(plane) - 1)
        out = np.empty(len(k), np.int64)
        for lo in range(0, len(k), BLOCK):    # BLOCK blocks of BLOCK bits at a time
            own = block[lo:lo + BLOCK]
            seen = np.cumsum(np.unpackbits(plane[own], axis=1) == bit, axis=1, dtype=np.uint16)
            out[lo:lo + BLOCK] = own * BLOCK + (seen > (k[lo:lo + BLOCK] - before[own])[:, None]).argmax(axis=1)
        return out

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        value = 0
        for l in range(self.levels):
            bit = self.planes[l][i >> 3] >> (7 - (i & 7)) & 1
            ones = self._ones(l, i)
            i = self.zeros[l] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token < 0 or token >> self.levels:
            return 0, 0
        for l in range(self.levels):
            a, b = self._ones(l, lo), self._ones(l, hi)
            lo, hi = (self.zeros[l] + a, self.zeros[l] + b) if token >> (self.levels - 1 - l) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """How often ``token`` occurs in positions lo .. hi - 1."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def locate(self, token: int, k: int) -> int:
        """Position of the ``k``-th (from 0) occurrence of ``token``."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for l in range(self.levels - 1, -1, -1):
            bit = token >> (self.levels - 1 - l) & 1
            i = self._at(l, i - self.zeros[l] if bit else i, bit)
        return i

    def locate_all(self, token: int) -> np.ndarray:
        """Positions of all occurrences of ``token``, ascending."""
        at = np.arange(*self._range(token, 0, self.n), dtype=np.int64)
        for l in range(self.levels - 1, -1, -1):
            bit = token >> (self.levels - 1 - l) & 1
            at = self._select(l, at - self.zeros[l] if bit else at, bit)
        return at
