"""Hashes of words and of word windows, computed over whole Arrow batches.

Everything is arithmetic on flat arrays modulo 2^64: a word's hash is a
polynomial over mixed byte values taken from prefix sums, a window's hash is
combined from hashes of windows half as long, with a mixing step between (so
the window hash is no polynomial).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
# bytes hashed at a time; longer texts are cut at white space
SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser (xor-shift and multiply) on unsigned 64-bit values."""
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


_BYTE = mix(np.arange(1, 257, dtype=U) * U(0xA24BAED4963EE407))
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    """Powers of the base ("up") or of its inverse modulo 2^64 ("down")."""
    if kind not in _powers or len(_powers[kind]) < n:
        base = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        factors = np.full(max(n, SLICE + 1), base, dtype=U)
        factors[0] = 1
        _powers[kind] = np.cumprod(factors)
    return _powers[kind]


def _slice_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """Word hashes of consecutive rows in ``data`` and each row's word count."""
    n = len(data)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(n + 1, dtype=U)
    np.cumsum(table[data] * _power("up", n)[:n], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _power("down", n)[starts]
    return mix(hashes + (ends - starts).astype(U)), np.diff(np.searchsorted(starts, offsets))


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column and the words per row (null: 0).

    ``lower`` takes A-Z for a-z.
    """
    texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    table = _LOWER if lower else _BYTE
    counts = np.zeros(len(texts), dtype=np.int64)
    parts, row = [], 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE, side="right")) - 1)
        lo, hi = int(offsets[row]), int(offsets[end])
        if end == row + 1 and hi - lo > SLICE:
            while lo < hi:
                cut = min(hi, lo + SLICE)
                while cut < hi and not _SPACE[data[cut]]:
                    cut += 1
                hashes, n = _slice_words(data[lo:cut], np.array([0, cut - lo]), table)
                parts.append(hashes)
                counts[row] += n[0]
                lo = cut
        else:
            hashes, n = _slice_words(data[lo:hi], offsets[row:end + 1] - lo, table)
            parts.append(hashes)
            counts[row:end] = n
        row = end
    return (np.concatenate(parts) if parts else np.zeros(0, dtype=U)), counts


def by_bytes(batch: pa.RecordBatch, column: int, limit: int = 4 << 20):
    """Parts of a batch with at most ``limit`` bytes of text each (or one row)."""
    texts = pc.fill_null(batch.column(column), "").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(ends, ends[row] + limit, side="right")) - 1)
        yield batch.slice(row, end - row)
        row = end


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each place on; places too late give windows cut short.

    Windows run across rows: the caller knows where a row ends.
    """
    out, size, done = None, 1, 0
    power = words
    while True:
        if width & size:
            if out is None:
                out = power
            else:
                tail = np.zeros_like(out)
                tail[:max(0, len(out) - done)] = power[done:]
                out = mix(out * U(0xFF51AFD7ED558CCD) + tail)
            done += size
        if done == width:
            return mix(out + U(width))
        nxt = np.zeros_like(power)
        nxt[:max(0, len(power) - size)] = power[size:]
        power = mix(power * U(0xC4CEB9FE1A85EC53) + nxt)
        size *= 2


def places(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For words dealt to rows by ``counts``: row, place in the row, words from there on."""
    row = np.repeat(np.arange(len(counts)), counts)
    begin = np.cumsum(counts) - counts
    place = np.arange(len(row)) - begin[row]
    return row, place, counts[row] - place
