"""Exact substring dedup by difference-cover anchors.

A set of places modulo a period is a difference cover if every difference of
two places occurs between members: for any two places i and j there is a shift
below the period that brings both onto the cover.  Two equal windows of W
words therefore share an equal *anchor*, a window of W - period + 1 words that
begins at a covered place in both.  So only covered places (5 of 21) are
hashed and compared in the first exchange.  Around anchors that occur
elsewhere, the match is extended: the full windows over them are compared by
their own 64-bit hashes, which settles each window without listing pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import attach
from .exchange import bucket_count, shared_places
from .hashing import places, window_hashes, word_hashes
from .shared import save

# fixed values: a perfect difference set, every difference modulo 21 occurs
PERIOD = 21
COVER = (0, 1, 4, 14, 16)


def _anchors(width: int):
    covered = np.zeros(PERIOD, dtype=bool)
    covered[list(COVER)] = True
    inner = width - PERIOD + 1

    def run(batch: pa.RecordBatch):
        words, counts = word_hashes(batch.column(1))
        row, place, left = places(counts)
        pick = np.flatnonzero(covered[place % PERIOD] & (left >= inner) & (counts[row] >= width))
        return batch.column(0).to_numpy(), row[pick], window_hashes(words, inner)[pick], place[pick]
    return run


def _extended(width: int):
    """Windows of full width that hold an anchor known to occur elsewhere."""
    def run(batch: pa.RecordBatch):
        words, counts = word_hashes(batch.column(1))
        row, place, left = places(counts)
        near = np.zeros(len(words) + 1, dtype=np.int64)
        marks = batch.column(2)
        begin = np.cumsum(counts) - counts
        at = marks.flatten().to_numpy().astype(np.int64)
        of = np.repeat(np.arange(batch.num_rows), np.diff(marks.offsets.to_numpy()))
        np.add.at(near, begin[of] + np.maximum(at - PERIOD + 1, 0), 1)
        np.add.at(near, begin[of] + at + 1, -1)
        pick = np.flatnonzero((np.cumsum(near)[:-1] > 0) & (left >= width))
        return batch.column(0).to_numpy(), row[pick], window_hashes(words, width)[pick], place[pick]
    return run


def _cut(width: int, texts: bool):
    """Removes the covered words of each text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, starts in zip(batch.column(1), batch.column(2)):
                # bytes.split() cuts at the six ASCII white-space bytes alone
                words = (text.as_py() or "").encode().split()
                n_words.append(len(words))
                if starts.is_valid and len(starts.values):
                    at = starts.values.to_numpy()
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(change, at, 1)
                    np.add.at(change, at + width, -1)
                    stay = np.cumsum(change)[:-1] == 0
                    words = [w for w, s in zip(words, stay.tolist()) if s]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            if not texts:
                kept = [hashlib.sha256(k).hexdigest() for k in kept]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.string()) if not texts else pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"])
    return run


def remove_repeats(docs: DataFrame, width: int = 35, texts: bool = True) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``, a row for each document.

    A word goes if a window of ``width`` words over it (of one document, as
    given) also starts anywhere else, in the same document or in a copy of it.
    ``kept`` is the text of the other words joined by single spaces, or with
    ``texts=False`` its SHA-256 in lowercase hex.  Null and empty texts have
    no words; texts of fewer than ``width`` words lose none; an empty table
    gives an empty result.  Documents are told apart by a 64-bit hash of id
    and text; rows alike in both are copies of each other.
    """
    if width < PERIOD:
        raise ValueError(f"width must be at least {PERIOD}, got {width}")
    attach(docs.sparkSession)
    rows = docs.select(F.xxhash64("doc_id", "text").alias("key"), "text", "doc_id")
    buckets = bucket_count(docs)
    marks = save(shared_places(rows.select("key", "text"), _anchors(width), buckets, False, True, 1), "anchors")
    # both joins read the texts by the same exchange
    near = (rows.join(marks.withColumnRenamed("key", "k"), F.col("key") == F.col("k"))
            .select("key", "text", "places", "doc_id"))
    windows = shared_places(near, _extended(width), buckets, True, True, 1)
    joined = rows.join(windows.withColumnRenamed("key", "k"), F.col("key") == F.col("k"), "left")
    return joined.select("doc_id", "text", "places").mapInArrow(
        _cut(width, texts), "doc_id long, n_words long, n_removed long, kept string")
