"""Which hashes occur elsewhere: an exchange of packed hash lists.

Rows of a table carry many hashes at places of their own (windows of a text,
shingles of a set).  To learn which of them occur more than once in the whole
table, every Arrow batch packs its hashes into one binary list per hash
bucket; a bucket's task compares the lists and answers with the places, packed
by the row keys' owner; an owner's task merges the answers of all buckets.  The
number of packed rows depends on the buckets and owners alone, not on how many
of them a row's hashes meet.  A hash that a batch already holds twice is known there and then:
only one mark of it is sent, so a hash that a third of all rows hold costs a
bucket no more than one entry per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import attach
from .hashing import by_bytes

ENTRY_SCHEMA = "bucket int, known boolean, keys binary, counts binary, hashes binary, places binary, marks binary"
_NAMES = ["bucket", "known", "keys", "counts", "hashes", "places", "marks"]
# text bytes whose hashes one bucket holds, and buckets at least
BUCKET_BYTES = 32 << 20
MIN_BUCKETS = 24
# buckets per owner, a share of the row keys whose places one task merges (owners: MIN_BUCKETS at least)
OWNED = 4
ANSWER_SCHEMA = "owner int, keys binary, counts binary, places binary"

#: (keys, row of each hash, hashes, places) of a batch
Hashed = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def bucket_count(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(MIN_BUCKETS, -(-size // bucket_bytes))


def _pack(hashed: Hashed, buckets: int, width: type, repeats: bool) -> Iterator[pa.RecordBatch]:
    keys, row, hashes, place = hashed
    # rows of one key are one row; where repeats count, all it has is known
    uniq, first, inverse, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    if len(uniq) < len(keys):
        stay = np.zeros(len(keys), dtype=bool)
        stay[first] = True
        keep = stay[row]
        row, hashes, place = row[keep], hashes[keep], place[keep]
        copied = (times[inverse] > 1)[row] if repeats else np.zeros(len(row), dtype=bool)
    else:
        copied = np.zeros(len(row), dtype=bool)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    begin = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] ^ np.uint64(1)) != 0) if len(ordered) else order
    size = np.diff(begin, append=len(ordered))
    many = np.repeat(size > 1, size)
    known = np.zeros(len(hashes), dtype=bool)
    known[order] = many
    known |= copied
    marks = np.unique(hashes[known])
    own = (hashes & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)
    own[known] = buckets + (keys[row[known]].view(np.uint64) % np.uint64(buckets))
    own = own.astype(np.int64)
    mark_bucket = ((marks & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)
    # by bucket, in order of row and place inside it
    by = np.argsort(own, kind="stable")
    cuts = np.searchsorted(own[by], np.arange(2 * buckets + 1))
    mark_by = np.argsort(mark_bucket, kind="stable")
    mark_cuts = np.searchsorted(mark_bucket[mark_by], np.arange(buckets + 1))
    short = (lambda h: (h >> np.uint64(32)).astype(np.uint32)) if width is np.uint32 else (lambda h: h)
    out: list[list] = [[] for _ in _NAMES]
    for b in range(2 * buckets):
        pick = by[cuts[b]:cuts[b + 1]]
        mark = marks[mark_by[mark_cuts[b]:mark_cuts[b + 1]]] if b < buckets else marks[:0]
        if not len(pick) and not len(mark):
            continue
        rows, counts = np.unique(row[pick], return_counts=True)
        for col, value in zip(out, (
                b, b >= buckets, keys[rows].tobytes(), counts.astype(np.uint32).tobytes(),
                b"" if b >= buckets else short(hashes[pick]).tobytes(),
                place[pick].astype(np.uint32).tobytes(), short(mark).tobytes())):
            col.append(value)
    types = [pa.int32(), pa.bool_()] + [pa.binary()] * 5
    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names=_NAMES)


def _arrays(table: pa.Table, name: str, dtype: type) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), dtype) for x in table.column(name)])


def _once(key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and their places in order, each pair once."""
    order = np.lexsort((place, key))
    key, place = key[order], place[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (place[1:] != place[:-1])
    return key[new], place[new]


def _answer(width: type, repeats: bool, owners: int):
    """The places of a bucket's shared hashes, a packed row for each owner of keys."""
    def run(table: pa.Table) -> pa.Table:
        keys, counts, place = (_arrays(table, "keys", np.int64), _arrays(table, "counts", np.uint32),
                               _arrays(table, "places", np.uint32))
        key = np.repeat(keys, counts)
        if not table.column("known")[0].as_py():
            hashes, marks = _arrays(table, "hashes", width), _arrays(table, "marks", width)
            order = np.argsort(hashes, kind="stable")
            ordered = hashes[order]
            new = np.diff(ordered, prepend=ordered[:1] ^ width(1)) != 0 if len(ordered) else order.astype(bool)
            begin = np.flatnonzero(new)
            size = np.diff(begin, append=len(ordered))
            if repeats:
                shared = size > 1
            elif len(begin):
                by = key[order]
                shared = np.minimum.reduceat(by, begin) != np.maximum.reduceat(by, begin)
            else:
                shared = size > 1
            shared |= np.isin(ordered[begin], marks)
            hit = np.zeros(len(hashes), dtype=bool)
            hit[order] = np.repeat(shared, size)
            key, place = key[hit], place[hit]
        # a key's places once, however many batches hold copies of its row
        key, place = _once(key, place)
        uniq, counts = np.unique(key, return_counts=True)
        owner = (uniq.view(np.uint64) % np.uint64(owners)).astype(np.int64)
        by, by_place = np.argsort(owner, kind="stable"), np.argsort(np.repeat(owner, counts), kind="stable")
        ends = np.cumsum(counts[by])
        out: list[list] = [[], [], [], []]
        for o in np.unique(owner).tolist():
            a, b = np.searchsorted(owner[by], [o, o + 1])
            pick = by_place[ends[a] - counts[by[a]]:ends[b - 1]]
            for col, value in zip(out, (o, uniq[by[a:b]].tobytes(), counts[by[a:b]].astype(np.uint32).tobytes(),
                                        place[pick].tobytes())):
                col.append(value)
        return pa.table([pa.array(v, t) for v, t in zip(out, [pa.int32()] + [pa.binary()] * 3)],
                        names=["owner", "keys", "counts", "places"])
    return run


def _merged(table: pa.Table) -> pa.Table:
    """All places of an owner's keys, each once."""
    key, place = _once(np.repeat(_arrays(table, "keys", np.int64), _arrays(table, "counts", np.uint32)),
                       _arrays(table, "places", np.uint32))
    uniq, begin = np.unique(key, return_index=True)
    offsets = np.append(begin, len(key)).astype(np.int32)
    return pa.table({"key": pa.array(uniq, pa.int64()),
                     "places": pa.ListArray.from_arrays(pa.array(offsets), pa.array(place.astype(np.int32)))})


def shared_places(rows: DataFrame, hashed: Callable[[pa.RecordBatch], Hashed], buckets: int,
                  exact: bool, repeats: bool, text: int = 0) -> DataFrame:
    """``(key, places)``: where rows hold hashes that occur elsewhere too.

    ``hashed`` gives the hashes of an Arrow batch of ``rows``, whose texts are
    in column ``text``; batches are cut by bytes of text.  With
    ``repeats`` any second occurrence counts, in the same row or in a copy of
    it; without, only one in a row of another key.  ``exact`` compares all 64
    bits, else 32 besides the bucket's (some places too many, none too few).
    Rows of one key count as one without ``repeats``, so a hash must have the
    same place in all of them.  Places are in no order; rows without such a hash are left out.
    """
    attach(rows.sparkSession)
    width = np.uint64 if exact else np.uint32

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, text):
                yield from _pack(hashed(part), buckets, width, repeats)

    answers = (rows.mapInArrow(pack, ENTRY_SCHEMA).groupBy("bucket")
               .applyInArrow(_answer(width, repeats, max(MIN_BUCKETS, -(-buckets // OWNED))), ANSWER_SCHEMA))
    return answers.groupBy("owner").applyInArrow(_merged, "key long, places array<int>")
