"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors of small integers are indexed in shards.  In a shard, a posting
segment holds the rows with one value in one dimension; for a query, the
segment's impact is the size of the product of the query's component and that
value.  Segments are processed by descending impact, quantised into levels
(finer towards 0).  After a level, a row can still gain at most the level's
floor in each dimension not met yet.  A dimension of which a level would
process a large share is added as a whole there, and bounded by its largest
impact until then.  The bar is the k-th best exact score of the rows that lead so far.
Processing stops only when the bound proves that few rows can reach the bar;
these are rescored exactly.

Scores that fit 62 bits are 64-bit sums.  For wider components a shard bounds
in doubles, with a margin for their rounding, and rescores in whole numbers of
any size; the sizes of the shard and the query decide, per shard and query.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import attach
from .shared import save
from .vectors import best_per_query, in_query_blocks, usable

SHARD_ROWS = 8192
LEVELS = 6
# share of a dimension's postings from which all of them are added at once
WHOLE = 0.25
# share of a shard that is rescored rather than process another level
RESCORED = 0.25
# sums below this are exact in 64 bits, and products below the other one in doubles
EXACT_SUMS, EXACT_DOUBLES = 1 << 62, 1 << 52
LONG = (1 << 63) - 1


def _largest(rows: np.ndarray) -> int:
    return max(int(rows.max()), -int(rows.min())) if rows.size else 0


def beyond(score: int) -> bytes | None:
    """An exact score at or beyond the ends of 64 bits, in the order of its size (other scores: None)."""
    return None if -LONG < score < LONG else (score + (1 << 255)).to_bytes(32, "big")


class Shard:
    """The index of some integer vectors of one dimension, rows ordered by id."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        posting, values, dim, value, start = [], [], [], [], []
        for d in range(rows.shape[1]):
            column = self.rows[:, d]
            by = np.argsort(column, kind="stable")
            ordered = column[by]
            begin = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] - 1))
            posting.append(by)
            values.append(ordered)
            dim.append(np.full(len(begin), d))
            value.append(ordered[begin])
            start.append(begin + d * len(ids))
        # a row of both for each dimension
        self.posting, self.values = np.stack(posting), np.stack(values).astype(np.float64)
        self.dim, self.value, self.start = np.concatenate(dim), np.concatenate(value), np.concatenate(start)
        self.first = np.flatnonzero(np.diff(self.dim, prepend=-1))
        self.sizes = np.abs(self.value.astype(np.float64))
        self.largest = _largest(self.rows)
        # products and their sums are exact in doubles where they are this small
        narrow = self.largest ** 2 * rows.shape[1] < EXACT_DOUBLES
        self.doubles = self.rows.astype(np.float64) if narrow else None
        self.columns = np.ascontiguousarray(self.rows.T, dtype=np.float64)
        self.counts = np.diff(self.start, append=self.posting.size)

    def scores(self, rows: np.ndarray, query: np.ndarray) -> list[int] | np.ndarray:
        """Exact inner products with some rows."""
        size = self.largest * _largest(query) * len(query)
        if self.doubles is not None and size < EXACT_DOUBLES:
            return (self.doubles[rows] @ query.astype(np.float64)).astype(np.int64)
        if size < EXACT_SUMS:
            return self.rows[rows] @ query
        wide = query.tolist()
        return [sum(map(mul, row, wide)) for row in self.rows[rows].tolist()]

    def best(self, query: np.ndarray, k: int, without: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The ids and exact scores of the k best rows (ties to the smaller id); wide scores are objects."""
        n, dims = self.rows.shape
        possible = np.arange(n) if without is None else np.flatnonzero(self.ids != without)
        k = min(k, len(possible))
        if not k:
            return self.ids[:0], self.ids[:0]
        impact = np.abs(query.astype(np.float64))[self.dim] * self.sizes
        most = np.maximum.reduceat(impact, self.first)
        top = float(most.max()) + 1
        # what rounding may take from a bound in doubles
        margin = 0.0 if top * dims < EXACT_DOUBLES else float(most.sum()) * dims * 2.0 ** -48
        level = np.minimum((LEVELS * np.sqrt(impact / top)).astype(np.int64), LEVELS - 1)
        highest = np.maximum.reduceat(level, self.first)
        # the level above 0 at which a dimension is added as a whole (0: segment by segment)
        filled = np.bincount(self.dim * LEVELS + level, self.counts, dims * LEVELS).reshape(dims, LEVELS)
        reached = filled[:, :0:-1].cumsum(axis=1) >= WHOLE * n
        whole = (reached * np.arange(LEVELS - 1, 0, -1)).max(axis=1, initial=0)
        # segments of one dimension and level that lie side by side
        run = np.flatnonzero(np.diff(self.dim * LEVELS + level, prepend=-1))
        begin, end = self.start[run], np.append(self.start[run[1:]], self.posting.size)
        order = np.argsort(-level[run], kind="stable")
        order = order[whole[self.dim[run[order]]] == 0]
        cuts = np.searchsorted(-level[run][order], -np.arange(LEVELS), side="right")
        segments = list(zip(begin[order].tolist(), end[order].tolist()))
        lengths, dealt = (end - begin)[order], query.astype(np.float64)
        factors = dealt[self.dim[run[order]]]
        # a sum of products and a count share a float where both fit
        unit = float(1 << 32) if top * dims < 1 << 31 else 0.0
        posting, values = self.posting.ravel(), self.values.ravel()
        score, met, done, postings = np.zeros(n), np.zeros(n), 0, 0
        for lowest in range(LEVELS - 1, -1, -1):
            new = slice(done, cuts[lowest])
            here = segments[new]
            done = cuts[lowest]
            added = np.flatnonzero(whole == lowest) if lowest else ()
            if len(added):
                score += dealt[added] @ self.columns[added]
            if here:
                rows = np.concatenate([posting[a:b] for a, b in here])
                weights = np.concatenate([values[a:b] for a, b in here])
                weights *= np.repeat(factors[new], lengths[new])
                weights += unit
                both = np.bincount(rows, weights, n)
                times = np.rint(both / unit) if unit else np.bincount(rows, minlength=n)
                score += both - times * unit
                met += times
                postings += len(rows)
            # a dimension not met yet adds less than the level's floor, and no more than its largest
            gain = top * (lowest / LEVELS) ** 2 + 1
            small = np.where(whole > 0, whole < lowest, highest < lowest)
            never, open_ = most[small].sum(), np.count_nonzero((whole == 0) & ~small)
            # too early to leave rows out: what an average row can gain is more than the best score
            if lowest and never + (open_ - postings / n) * gain > score.max():
                continue
            # exact scores of the leaders give the bar
            lead = possible[np.argpartition(score[possible], len(possible) - k)[-min(4 * k, len(possible)):]]
            bar = float(sorted(self.scores(lead, query))[-k])
            bound = (score + (never + margin) + (open_ - met) * gain)[possible]
            left = possible[bound >= bar]
            if len(left) <= max(4 * k, RESCORED * n):
                possible = left
                break
        exact, ids = self.scores(possible, query), self.ids[possible]
        if isinstance(exact, np.ndarray):
            first = np.lexsort((ids, -exact))[:k]
            return ids[first], exact[first]
        found = sorted(zip(exact, ids.tolist()), key=lambda x: (-x[0], x[1]))[:k]
        return np.array([i for _, i in found]), np.array([x for x, _ in found], dtype=object)

    def pack(self) -> bytes:
        kind = np.int32 if self.largest < 1 << 31 else np.int64
        return (np.array([len(self.ids), self.rows.shape[1], np.dtype(kind).itemsize], np.int64).tobytes()
                + self.ids.tobytes() + self.rows.astype(kind).tobytes())

    @classmethod
    def unpack(cls, image: bytes) -> Shard:
        n, dims, size = np.frombuffer(image, np.int64, 3)
        return cls(np.frombuffer(image, np.int64, n, 24),
                   np.frombuffer(image, f"i{size}", n * dims, 24 + 8 * n).reshape(n, dims).astype(np.int64))


def _build(shard_rows: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def close(dim: int) -> pa.RecordBatch:
            parts = held.pop(dim)
            shard = Shard(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([shard.pack()], pa.binary())],
                                              names=["dim", "image"])

        for batch in batches:
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            ids = batch.column(0).to_numpy()
            for dim in np.unique(sizes).tolist():
                pick = np.flatnonzero(sizes == dim)
                rows = lists.take(pa.array(pick)).flatten().to_numpy().reshape(-1, dim)
                for lo in range(0, len(pick), shard_rows):
                    held.setdefault(dim, []).append((ids[pick[lo:lo + shard_rows]], rows[lo:lo + shard_rows]))
                    if sum(len(p[0]) for p in held[dim]) >= shard_rows:
                        yield close(dim)
        for dim in list(held):
            yield close(dim)
    return run


def _search(queries, k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, image in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids, rows = queries.value.get(dim, ((), ()))
                if not len(ids):
                    continue
                shard = Shard.unpack(image.as_py())
                found = [shard.best(q, k, i) for i, q in zip(ids.tolist(), rows)]
                sizes = [len(f[0]) for f in found]
                scores = [x for f in found for x in f[1].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, sizes), pa.int64()),
                     pa.array(np.concatenate([f[0] for f in found]), pa.int64()),
                     pa.array([min(max(x, -LONG - 1), LONG) for x in scores], pa.int64()),
                     pa.array([beyond(x) for x in scores], pa.binary())],
                    names=["query_id", "vec_id", "score", "beyond"])
    return run


def quantised(vectors: DataFrame, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, v)``: components as floor(scale * x); rows that are not usable go.

    Components beyond 64 bits stop at its ends.
    """
    return (vectors.filter(usable(F.col(vec_col)) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v")))


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index, a row per shard, from ``(vec_id, v)`` with integer vectors ``v``."""
    attach(vectors.sparkSession)
    n = max(1, -(-vectors.count() // shard_rows))
    return save(vectors.repartition(n).mapInArrow(_build(shard_rows), "dim int, image binary"), "impact-index")


def search_index(index: DataFrame, queries: DataFrame, dim: int, k: int) -> DataFrame:
    """The exact k largest inner products of every query with all other rows.

    ``queries (vec_id, v)``; a row is no candidate of a query with its own id,
    and vectors of another length are none either.  Fewer than k candidates
    give all there are.  Queries that repeat an id count once (the smallest
    vector).  Components may have any 64-bit value: rows are ranked by their
    exact scores, and a score beyond 64 bits is shown as the nearest end of
    these.  An empty index or query set gives an empty result.
    """
    spark = index.sparkSession

    def block(table: pa.Table):
        ids, lists = table.column("vec_id").to_numpy(), table.column("v").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, int)
        by_dim = {}
        for d in np.unique(sizes).tolist():
            pick = np.flatnonzero(sizes == d)
            by_dim[d] = (ids[pick], lists.take(pa.array(pick)).flatten().to_numpy().reshape(-1, d))
        held = spark.sparkContext.broadcast(by_dim)
        found = index.mapInArrow(_search(held, k), "query_id long, vec_id long, score long, beyond binary")
        return best_per_query(found, k, "long", F.col("beyond").desc()), held

    once = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    return in_query_blocks(once, dim, block, "impact-found")
