"""A wavelet matrix over token ids: one succinct file image per shard.

The ids' bits are stored as one bit-plane per bit, highest first; each plane
is the bits of the sequence after a stable split of the sequence by the plane
before (zeros first).  With counts of ones per block, ``rank`` and ``select``
on a plane are a look-up and a short scan, and any id can be read, counted in
a range, or located without decoding the shard.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"WAVM0001"
BLOCK = 512                      # bits between two stored rank counts
_ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)


def _narrow(bits: int):
    return np.uint16 if bits <= 16 else np.uint32


def build(ids: np.ndarray, doc_ids: np.ndarray, null_ids: np.ndarray, lengths: np.ndarray,
          bits: int) -> bytes:
    """The file image: header, document directory, planes and rank counts."""
    a = ids.astype(_narrow(bits))
    out = [MAGIC, struct.pack("<QQI", len(a), len(doc_ids), bits),
           np.asarray(doc_ids, "<i8").tobytes(), np.asarray(null_ids, "u1").tobytes(),
           np.asarray(lengths, "<u8").tobytes()]
    for b in range(bits - 1, -1, -1):
        ones = (a & a.dtype.type(1 << b)).astype(bool)
        packed = np.packbits(ones)
        padded = np.zeros(-(-len(a) // BLOCK) * (BLOCK // 8), dtype=np.uint8)
        padded[:len(packed)] = packed
        counts = np.bitwise_count(padded.view("<u8")).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
        before = np.concatenate([[0], np.cumsum(counts)]).astype("<u4")
        zeros = a[np.flatnonzero(~ones)]
        out += [struct.pack("<Q", len(zeros)), before.tobytes(), padded.tobytes()]
        a = np.concatenate([zeros, a[np.flatnonzero(ones)]])
    return b"".join(out)


class Shard:
    """Reads a file image; the planes are views of it."""

    def __init__(self, image: bytes):
        if image[:8] != MAGIC:
            raise ValueError("not a wavelet-matrix image")
        self.n, docs, self.bits = struct.unpack_from("<QQI", image, 8)
        at = 28

        def take(dtype, count):
            nonlocal at
            view = np.frombuffer(image, dtype, count, at)
            at += view.nbytes
            return view

        self.doc_ids, self.null_ids, self.lengths = take("<i8", docs), take("u1", docs), take("<u8", docs)
        blocks = -(-self.n // BLOCK)
        self.planes = []
        for _ in range(self.bits):
            zeros = int(take("<u8", 1)[0])
            self.planes.append((zeros, take("<u4", blocks + 1), take("u1", blocks * BLOCK // 8)))

    def decode(self) -> np.ndarray:
        """All ids, by undoing the splits from the lowest plane up."""
        a = np.zeros(self.n, dtype=_narrow(self.bits))
        for b, (zeros, _, packed) in enumerate(reversed(self.planes)):
            ones = np.unpackbits(packed, count=self.n).view(bool)
            up = np.empty_like(a)
            up[np.flatnonzero(~ones)] = a[:zeros]
            up[np.flatnonzero(ones)] = a[zeros:] | a.dtype.type(1 << b)
            a = up
        return a

    def _ones_before(self, plane, i: int) -> int:
        """Rank: ones among the first ``i`` bits of a plane."""
        _, before, packed = plane
        block, rest = divmod(i, BLOCK)
        at = block * BLOCK // 8
        full, part = divmod(rest, 8)
        total = int(before[block]) + int(_ONES[packed[at:at + full]].sum())
        return total + (int(_ONES[packed[at + full] >> (8 - part)]) if part else 0)

    def _place(self, plane, one: bool, k: int) -> int:
        """Select: where the ``k``-th (from 0) one or zero of a plane is."""
        _, before, packed = plane
        have = before.astype(np.int64)
        if not one:
            have = np.arange(len(before), dtype=np.int64) * BLOCK - have
        block = int(np.searchsorted(have, k, side="right")) - 1
        bits = np.unpackbits(packed[block * BLOCK // 8:(block + 1) * BLOCK // 8])
        hits = np.flatnonzero(bits == (1 if one else 0))
        return block * BLOCK + int(hits[k - have[block]])

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane in self.planes:
            zeros, _, packed = plane
            one = (int(packed[i >> 3]) >> (7 - (i & 7))) & 1
            before = self._ones_before(plane, i)
            i = zeros + before if one else i - before
            value = value << 1 | one
        return value

    def _interval(self, symbol: int, lo: int, hi: int) -> tuple[int, int]:
        for b, plane in zip(range(self.bits - 1, -1, -1), self.planes):
            first, last = self._ones_before(plane, lo), self._ones_before(plane, hi)
            lo, hi = (plane[0] + first, plane[0] + last) if symbol >> b & 1 else (lo - first, hi - last)
        return lo, hi

    def count(self, symbol: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of an id at places from ``lo`` to before ``hi``."""
        if symbol >> self.bits:
            return 0
        first, last = self._interval(symbol, lo, self.n if hi is None else hi)
        return last - first

    def occurrence(self, symbol: int, k: int) -> int:
        """The place of the ``k``-th (from 0) occurrence of an id."""
        first, last = self._interval(symbol, 0, self.n) if not symbol >> self.bits else (0, 0)
        if not 0 <= k < last - first:
            raise IndexError(k)
        i = first + k
        for b, plane in enumerate(reversed(self.planes)):
            one = bool(symbol >> b & 1)
            i = self._place(plane, one, i - plane[0] if one else i)
        return i
