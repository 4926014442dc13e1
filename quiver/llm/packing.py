"""Best-fit packing of documents into sequences, by hierarchical residuals.

Each partition packs its pieces by best fit decreasing and emits the bins
that are nearly full.  Underfull bins become items of the next round, in a
quarter of the partitions, until one partition or no progress is left.  A
bin carries the list of its pieces (a few numbers each), never ids or texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import attach
from .encode import BATCH_BYTES, crc, encoder, with_ends
from .hashing import by_bytes
from .shared import save

# a bin with this much room or less is emitted at once
ROOM = 8
ITEMS_PER_TASK = 50_000
FAN_IN = 4
MEMBER = "struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint>"
MEMBER_ARROW = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                          ("length", pa.int64()), ("ids_crc32", pa.int64())])


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for rows in (p for batch in batches for p in by_bytes(batch, 1, BATCH_BYTES)):
            doc, piece, start, length, sums = [], [], [], [], []
            ids, ends = with_ends(*encode.many(rows.column(1)), end_id)
            raw, begin = ids.tobytes(), 0
            for d, stop in zip(rows.column(0).to_pylist(), (4 * ends).tolist()):
                for k, at in enumerate(range(begin, stop, 4 * capacity)):
                    part = raw[at:min(stop, at + 4 * capacity)]
                    doc.append(d)
                    piece.append(k)
                    start.append((at - begin) // 4)
                    length.append(len(part) // 4)
                    sums.append(crc(part))
                begin = stop
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(sums, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """Every document's ids (its end id last) in pieces of at most ``capacity``."""
    attach(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        _pieces(vocabulary, end_id, capacity),
        "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best fit decreasing: the bin of each item, and each bin's fill.

    Open bins are kept by the room they have; a bit mask of the rooms in use
    gives the smallest one that is large enough.
    """
    bins = np.empty(len(sizes), dtype=np.int64)
    fill: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    order = np.argsort(-sizes, kind="stable")
    for item, size in zip(order.tolist(), sizes[order].tolist()):
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
            fill[b] += size
            room -= size
        else:
            b, room = len(fill), capacity - size
            fill.append(size)
        if room:
            if not by_room[room]:
                mask |= 1 << room
            by_room[room].append(b)
        bins[item] = b
    return bins, np.array(fill, dtype=np.int64)


def _round(capacity: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        sizes = table.column("fill").to_numpy().astype(np.int64)
        members = table.column("members").combine_chunks()
        bins, fill = best_fit(sizes, capacity)
        order = np.argsort(bins, kind="stable")
        counts = np.diff(members.offsets.to_numpy())[order]
        lists = members.take(pa.array(order))
        ends = np.cumsum(counts)[np.flatnonzero(np.diff(bins[order], append=len(fill)))]
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(fill, pa.int64()), pa.ListArray.from_arrays(offsets, lists.flatten())],
            names=["fill", "members"])
    return run


def pack_pieces(pieces: DataFrame, capacity: int, room: int = ROOM,
                items_per_task: int = ITEMS_PER_TASK) -> DataFrame:
    """Pieces of length 1 to ``capacity`` with the sequence and offset of each.

    Adds ``sequence_id`` (any numbers) and ``offset`` to the columns of
    :func:`token_pieces`.  Pieces are laid gapless from 0.  No task of a later
    round gets more items than one of the first; where underfull bins stay
    too many for one task and stop merging, the rounds end.
    """
    attach(pieces.sparkSession)
    schema = f"fill long, members array<{MEMBER}>"
    items = pieces.select(F.col("length").alias("fill"), F.array(F.struct(
        "doc_id", "piece", "start", "length", "ids_crc32").cast(MEMBER)).alias("members"))
    n = pieces.count()
    tasks = max(1, -(-n // items_per_task))
    done = []
    while True:
        packed = save(items.repartition(tasks).mapInArrow(_round(capacity), schema), "packed")
        full = F.col("fill") >= capacity - room
        left = packed.filter(~full).count() if tasks > 1 else 0
        if not left:
            done.append(packed)
            break
        fewer = max(1, -(-tasks // FAN_IN), -(-left // items_per_task))
        if fewer >= tasks and left > 0.99 * n:
            done.append(packed)
            break
        done.append(packed.filter(full))
        items, tasks, n = packed.filter(~full), min(fewer, tasks), left
    bins = done[0]
    for more in done[1:]:
        bins = bins.unionByName(more)
    return (bins.select(F.monotonically_increasing_id().alias("sequence_id"), "members")
            .mapInArrow(_lay_out, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                  "sequence_id long, offset long"))


def _lay_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        members = batch.column(1)
        counts = np.diff(members.offsets.to_numpy())
        flat = members.flatten()
        lengths = flat.field("length").to_numpy().astype(np.int64)
        before = np.cumsum(lengths) - lengths
        firsts = np.cumsum(counts) - counts
        offset = before - np.repeat(before[firsts] if len(firsts) else before, counts)
        yield pa.RecordBatch.from_arrays(
            [flat.field(i) for i in range(5)]
            + [pa.array(np.repeat(batch.column(0).to_numpy(), counts), pa.int64()), pa.array(offset, pa.int64())],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """All documents packed into few sequences of at most ``capacity`` tokens.

    A null or empty text is a document of the end id alone.  Only documents
    longer than a sequence are cut.  Rows that repeat are documents of their
    own; no documents give no sequences.
    """
    pieces = save(token_pieces(docs, vocabulary, end_id, capacity), "pieces", BATCH_BYTES)
    return pack_pieces(pieces, capacity)
