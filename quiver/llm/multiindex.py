"""Approximate nearest neighbours by an inverted multi-index.

Unit vectors are cut in two halves, and each half is quantised by a codebook
of its own; a pair of centroids is a cell, and a cell's list holds the vectors
nearest to both.  A query walks the cells by ascending sum of its two centroid
distances, with a heap over pairs, until the lists visited hold a given share
of all rows, and their entries are reranked by exact cosine.

The codebooks are fitted on a bounded sample; every vector is indexed.  The
index is range-partitioned by cell and id, so a cell that holds a third of all
rows is spread over several partitions.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import attach
from .shared import save
from .vectors import best_per_query, in_query_blocks, matrix, usable

CENTROIDS = 64
SAMPLE = 20_000
STEPS = 12
# share of all rows that a query reranks: the recall of unstructured vectors
# in 64 dimensions needs about this much
SHARE = 0.5
# screened scores this close to the k-th best are settled by exact scores
MARGIN = 1e-9
INDEX_SCHEMA = "cell int, vec_id long, v array<double>"
FOUND_SCHEMA = "query_id long, vec_id long, score double"
# queries whose cells one task walks
WALKS_PER_TASK = 512


def fit_codebook(rows: np.ndarray, centroids: int, seed: int) -> np.ndarray:
    """Lloyd's method from distinct random rows (fewer rows: fewer centroids)."""
    rng = np.random.Generator(np.random.PCG64(seed))
    distinct = np.unique(rows, axis=0)
    book = distinct[rng.permutation(len(distinct))[:centroids]].copy()
    for _ in range(STEPS):
        near = nearest(rows, book)
        count = np.bincount(near, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, near, rows)
        book[count > 0] = sums[count > 0] / count[count > 0, None]
    return book


def distances(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances up to a constant per row."""
    return (book * book).sum(axis=1) - 2 * rows @ book.T


def nearest(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.argmin(distances(rows, book), axis=1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length 1, scaled first so that squares neither overflow nor vanish."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def halves(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two parts that are quantised (of one component: itself and nothing)."""
    if units.shape[1] == 1:
        return units, np.zeros_like(units)
    half = units.shape[1] // 2
    return units[:, :half], units[:, half:]


def walk_cells(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: float) -> list[int]:
    """Cells by ascending sum of both distances until their lists hold ``enough`` rows.

    The multi-sequence walk: a pair enters the heap when both pairs before it
    (one step back in either order) have left it.
    """
    by1, by2 = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    d1, d2 = first[by1].tolist(), second[by2].tolist()
    width, held, out = len(d2), 0, []
    heap = [(d1[0] + d2[0], 0, 0)]
    reached = [0] * len(d1)          # pairs taken so far in each row of the grid
    size = sizes.tolist()
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        reached[i] = j + 1
        cell = by1[i] * width + by2[j]
        if size[cell]:
            out.append(cell)
            held += size[cell]
        if i + 1 < len(d1) and reached[i + 1] == j:
            heapq.heappush(heap, (d1[i + 1] + d2[j], i + 1, j))
        if j + 1 < width and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (d1[i] + d2[j + 1], i, j + 1))
    return out


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosine in double precision; each row's sums run in one order."""
    dot = (a * b).sum(axis=1)
    return dot / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _assign(books, dim: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book1, book2 = books.value
        for batch in batches:
            if batch.num_rows:
                one, two = halves(unit(matrix(batch.column(1), dim)))
                cell = nearest(one, book1) * len(book2) + nearest(two, book2)
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), batch.column(0), batch.column(1)],
                                                 names=["cell", "vec_id", "v"])
    return run


def _walks(books, sizes: np.ndarray, enough: float, dim: int):
    """The cells that each query visits."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                parts = halves(unit(matrix(batch.column(1), dim)))
                near = [distances(part, book) for part, book in zip(parts, books.value)]
                visits = [walk_cells(a, b, sizes, enough) for a, b in zip(*near)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1),
                                                  pa.array(visits, pa.list_(pa.int32()))],
                                                 names=["vec_id", "v", "cells"])
    return run


def _scan(held, k: int, dim: int):
    """The k best of each query among the lists it visits, over one task's part of the index."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, visitors = held.value
        units = unit(rows) if len(rows) else rows
        best = {"q": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "s": np.zeros(0)}
        floor = np.full(len(ids), -np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, vec_ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            all_rows = matrix(batch.column(2), dim)
            all_units = unit(all_rows)
            begin = np.flatnonzero(np.diff(cells, prepend=-1))
            for lo, hi in zip(begin.tolist(), np.append(begin[1:], len(cells)).tolist()):
                who = visitors.get(int(cells[lo]))
                if who is None:
                    continue
                screen = units[who] @ all_units[lo:hi].T
                screen[ids[who][:, None] == vec_ids[None, lo:hi]] = -np.inf
                limit = floor[who]
                if hi - lo > k:
                    limit = np.maximum(limit, np.partition(screen, hi - lo - k, axis=1)[:, hi - lo - k])
                q, r = np.nonzero((screen >= limit[:, None] - MARGIN) & (screen > -np.inf))
                new = {"q": [], "id": [], "s": []}
                for at in range(0, len(q), 50_000):
                    i, j = who[q[at:at + 50_000]], r[at:at + 50_000] + lo
                    new["q"].append(i)
                    new["id"].append(vec_ids[j])
                    new["s"].append(cosines(rows[i], all_rows[j]))
                best = {c: np.concatenate([best[c], *new[c]]) for c in best}
                if len(best["q"]) > 4 * k * len(ids) + 50_000:
                    best, floor = _keep(best, k, len(ids))
        best, _ = _keep(best, k, len(ids))
        yield pa.RecordBatch.from_arrays([pa.array(ids[best["q"]], pa.int64()), pa.array(best["id"], pa.int64()),
                                          pa.array(best["s"], pa.float64())], names=["query_id", "vec_id", "score"])
    return run


def _keep(best: dict, k: int, queries: int) -> tuple[dict, np.ndarray]:
    order = np.lexsort((best["id"], -best["s"], best["q"]))
    q = best["q"][order]
    rank = np.arange(len(q)) - np.searchsorted(q, q, side="left")
    kept = {c: v[order[rank < k]] for c, v in best.items()}
    floor = np.full(queries, -np.inf)
    last = order[rank == k - 1]
    floor[best["q"][last]] = best["s"][last]
    return kept, floor


def usable_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` in double precision; null, zero and non-finite vectors go."""
    vec = F.col(vec_col)
    return (vectors.filter(usable(vec) & F.exists(vec, lambda x: x != 0) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("vec_id"), vec.cast("array<double>").alias("v")))


def search_multi_index(vectors: DataFrame, queries: DataFrame, k: int, centroids: int = CENTROIDS,
                       share: float = SHARE, sample: int = SAMPLE, seed: int = 1) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of every query.

    Both tables hold ``(vec_id, v)`` as of :func:`usable_vectors`.  Vectors of
    another length than a query's are no candidates: each length has an index
    of its own.  A row is no candidate of a query with its own id; ties go to
    the smaller id; queries that repeat an id count once (the smallest
    vector).  The codebooks are fitted on a hash sample of about ``sample``
    rows.  Empty tables give an empty result.
    """
    attach(vectors.sparkSession)
    once = save(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "multi-queries")
    found = [_search_length(vectors.filter(F.size("v") == dim), once.filter(F.size("v") == dim), dim, m, k, centroids,
                            share, sample, seed)
             for dim, m in once.groupBy(F.size("v").alias("d")).count().orderBy("d").collect()]
    empty = best_per_query(vectors.sparkSession.createDataFrame([], FOUND_SCHEMA), k, "double")
    return reduce(DataFrame.unionByName, found) if found else empty


def _search_length(vectors: DataFrame, queries: DataFrame, dim: int, n_queries: int, k: int, centroids: int,
                   share: float, sample: int, seed: int) -> DataFrame:
    """The search among vectors of one length."""
    spark = vectors.sparkSession
    n = vectors.count()
    drawn = (vectors.filter(F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1 << 30))
                            < int((1 << 30) * min(1.0, sample / max(n, 1))))
             .limit(2 * sample).select("v").toArrow().column("v").combine_chunks())
    if not len(drawn):
        drawn = vectors.select("v").limit(sample).toArrow().column("v").combine_chunks()
    if not len(drawn):
        return best_per_query(spark.createDataFrame([], FOUND_SCHEMA), k, "double")
    one, two = halves(unit(matrix(drawn, dim)))
    books = (fit_codebook(one, centroids, seed), fit_codebook(two, centroids, seed + 1))
    shared = spark.sparkContext.broadcast(books)
    order = ["cell", F.xxhash64("vec_id")]
    index = save(vectors.mapInArrow(_assign(shared, dim), INDEX_SCHEMA).repartitionByRange(*order)
                 .sortWithinPartitions("cell", "vec_id"), "multi-index")
    sizes = np.zeros(len(books[0]) * len(books[1]), dtype=np.int64)
    for cell, m in index.groupBy("cell").count().collect():     # a row per cell: bounded by the codebooks
        sizes[cell] = m
    tasks = -(-n_queries // WALKS_PER_TASK)
    walked = save(queries.repartition(tasks, "vec_id").mapInArrow(
        _walks(shared, sizes, share * n, dim), "vec_id long, v array<double>, cells array<int>"), "multi-walks")
    shared.destroy()

    def block(table: pa.Table):
        ids = table.column("vec_id").to_numpy()
        raw = matrix(table.column("v").combine_chunks(), dim) if len(ids) else np.zeros((0, dim))
        lists = table.column("cells").combine_chunks()
        cell, who = lists.flatten().to_numpy(), np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
        by = np.argsort(cell, kind="stable")
        uniq, begin = np.unique(cell[by], return_index=True)
        visitors = dict(zip(uniq.tolist(), np.split(who[by], begin[1:]))) if len(uniq) else {}
        held = spark.sparkContext.broadcast((ids, raw, visitors))
        return best_per_query(index.mapInArrow(_scan(held, k, dim), FOUND_SCHEMA), k, "double"), held

    # a block carries its visits too: up to a number per cell and query
    return in_query_blocks(walked, dim + len(sizes) // 2, block, "multi-found")
