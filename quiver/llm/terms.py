"""Terms of whole Arrow text columns, found on their UTF-8 bytes.

A term is a maximal run of bytes of some class; classes hold every byte from
0x80 on or none, so a run never cuts a character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BYTE = np.arange(256)
#: A-Z, a-z and everything beyond ASCII
LETTERS = (_BYTE >= 0x80) | ((_BYTE | 0x20) >= 0x61) & ((_BYTE | 0x20) <= 0x7A)
#: these and 0-9
LETTERS_AND_DIGITS = LETTERS | (_BYTE >= 0x30) & (_BYTE <= 0x39)
#: A-Z as a-z, all else as it is
LOWERED = np.where((_BYTE >= 0x41) & (_BYTE <= 0x5A), _BYTE + 32, _BYTE).astype(np.uint8)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column (null: empty) and where each row begins and ends in them."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def term_spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first byte and length of every term, in order."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    inside = kind[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return np.searchsorted(offsets, starts, side="right") - 1, starts, ends - starts


def spaced_terms(texts: pa.Array, kind: np.ndarray) -> pa.Array:
    """The column with A-Z as a-z and a space for every byte that is in no term."""
    data, offsets = text_bytes(texts)
    shown = np.where(kind, LOWERED, np.uint8(0x20))[data]
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(shown))


def strings_at(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The given spans of ``data`` as a string column."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    at = np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets),
                                            pa.py_buffer(np.ascontiguousarray(data[at]))).cast(pa.string())
