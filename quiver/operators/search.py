"""Search jobs: top-k, per-query / per-group top-k, radius, scoring.

Plan shape of every search (checked with ``explain``):

    scan(id, vector cols)  ->  mapInArrow(score + running top-k per task)
        ->  TakeOrderedAndProject (one query)
        or  Exchange(hash key) -> WindowGroupLimit/row_number<=k (per key)

Only the row key and the vector columns reach the Python tasks (Catalyst
prunes the scan, filters below the call are pushed to Parquet); payload
columns can be joined back on the winners.  Inside a plan every column has a
name of its own (:mod:`quiver.plans.keys`), so input columns may have any
name.  Keys may have any type that Spark can sort, and several columns.

Query points reach the tasks as a size-checked broadcast.  When a query table
is larger, ``search_many`` broadcasts the (measured) vector table instead, or
cuts the queries into several broadcasts and scans the vectors once for each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType

from ..functions.vectors import cosine_distance
from ..plans.bank import (QueryBank, broadcast_bank, broadcast_banks, collect_bank, fits_broadcast,
                          vector_table_size)
from ..plans.keys import RowKey, quoted
from ..plans.session import (DEFAULT_BROADCAST_BYTES, attach, default_parallelism, materialize,
                             planned_bytes, planned_tasks)
from ..plans.topk import auto_salt, global_top_k, top_k_per_key
from .refine import REFINED_PER_TASK, refine_with_ids
from .scoring import (VectorSpec, candidate_ddl, point_scorer, query_side_scorer,
                      radius_scorer, topk_scorer)
from .sfs import RefineOptions, refine


# queries per task when the vector table is the broadcast side
QUERIES_PER_TASK = 20_000


def _spark(df: DataFrame) -> SparkSession:
    attach(df.sparkSession)
    return df.sparkSession


def refined_point(spark: SparkSession, query, options: RefineOptions | None = None,
                  exact: bool = False):
    """The point rows are scored against for one constant query.

    A literal query is a constant, and its refinement is a pure function
    of that constant (3,050 objective evaluations, independent of any
    table), so it is folded here, once, the way Catalyst folds constant
    expressions while planning.  Query *tables* are refined as Spark jobs
    (:func:`quiver.operators.refine.refine_queries`); both use the same
    seeded kernel, so they give the same point.  Returns float64 or None.
    """
    if query is None or any(v is None for v in query):
        return None
    q = np.asarray(query, dtype=np.float64)
    if exact:
        return q
    best, _ = refine(q[None, :], options or RefineOptions())
    return best[0]


def _single_bank(spark, query, options, exact):
    """A literal is in driver memory already, so its broadcast needs no check."""
    return broadcast_bank(spark, QueryBank.single(refined_point(spark, query, options, exact)))


def _require_k(k: int):
    if int(k) != k or k < 1:
        raise ValueError(f"k must be a positive integer, got {k!r}")


def _inner(df: DataFrame, key: RowKey, spec: VectorSpec, *more: Column) -> DataFrame:
    """What a scoring task reads, under inner names."""
    return df.select(*key.select(), *spec.select(), *more)


# ---------------------------------------------------------------- S1 / S1e

def search(df: DataFrame, query, k: int = 10, vec="embedding", id_col="id",
           options: RefineOptions | None = None, exact: bool = False,
           dist_col: str = "dist") -> DataFrame:
    """The ``k`` rows nearest to one constant query: ``(key columns, dist)``.

    ``id_col`` names the row key: a column or a list of columns.  ``exact=True``
    is S1e (plain cosine, no refinement).  Order is ``dist ASC NULLS LAST``,
    then the key (NULL first); keys are expected to be unique.
    """
    _require_k(k)
    spark = _spark(df)
    spec, key = VectorSpec(vec), RowKey(df, id_col)
    bank_bc = _single_bank(spark, query, options, exact)
    cands = _inner(df, key, spec).mapInArrow(topk_scorer(bank_bc, spec.inner(), key, k), candidate_ddl(key))
    return global_top_k(cands, key, k).select(*key.restore(), F.col("__d").alias(dist_col))


def exact_search(df: DataFrame, query, k: int = 10, **kw) -> DataFrame:
    """S1e."""
    return search(df, query, k, exact=True, **kw)


def with_payload(top: DataFrame, df: DataFrame, id_col: str, payload: list[str]) -> DataFrame:
    """Join wide payload columns back onto winners.

    Spark picks the join from the sizes it measures: the winners of a plain
    search are few and get broadcast, those of a search per group or query
    need not be.
    """
    return df.select(quoted(id_col), *[quoted(c) for c in payload]).join(top, id_col)


# ---------------------------------------------------------------- S1g

def search_groups(df: DataFrame, query, by: str, k: int = 10, vec="embedding",
                  id_col="id", options: RefineOptions | None = None,
                  exact: bool = False, dist_col: str = "dist",
                  salt_buckets: int | None = None) -> DataFrame:
    """S1g: top-k per value of ``by``: ``(by, rank, key columns, dist)``.

    Each task keeps k rows per group, so a group holding a third of the
    table sends no more rows to the shuffle than any other.
    """
    _require_k(k)
    spark = _spark(df)
    spec, key = VectorSpec(vec), RowKey(df, id_col)
    bank_bc = _single_bank(spark, query, options, exact)
    group = df.schema[by].dataType
    cands = _inner(df, key, spec, quoted(by).alias("__g")).mapInArrow(
        topk_scorer(bank_bc, spec.inner(), key, k, group_type=to_arrow_type(group)),
        candidate_ddl(key, group_type=group.simpleString()))
    salt = salt_buckets if salt_buckets is not None else auto_salt(planned_tasks(df), k)
    out = top_k_per_key(cands, ["__g"], key, k, salt)
    return out.select(F.col("__g").alias(by), F.col("__r").alias("rank"), *key.restore(),
                      F.col("__d").alias(dist_col))


# ---------------------------------------------------------------- S1r

def radius_search(df: DataFrame, query, radius: float, vec="embedding", id_col="id",
                  options: RefineOptions | None = None, exact: bool = False,
                  dist_col: str = "dist") -> DataFrame:
    """S1r: every row with ``dist <= radius`` to one constant query: ``(key columns, dist)``.

    NULL and NaN distances never match.
    """
    spark = _spark(df)
    spec, key = VectorSpec(vec), RowKey(df, id_col)
    bank_bc = _single_bank(spark, query, options, exact)
    cands = _inner(df, key, spec).mapInArrow(radius_scorer(bank_bc, spec.inner(), key, float(radius)),
                                             candidate_ddl(key))
    return cands.select(*key.restore(), F.col("__d").alias(dist_col))


def radius_many(vectors: DataFrame, queries: DataFrame, radius: float, vec="embedding", id_col="id",
                query_id_col="query_id", query_col: str = "query",
                options: RefineOptions | None = None, exact: bool = False, dist_col: str = "dist",
                broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """S1r for a query table: every (query, row) pair with ``dist <= radius``.

    Only matches leave a task.  Returns ``(query key, row key, dist)``.
    """
    _spark(vectors)
    spec, key = VectorSpec(vec), RowKey(vectors, id_col)
    query_key = RowKey(queries, query_id_col, "__k")
    points, rows, elements = query_points(queries, query_key, query_col, options, exact, broadcast_bytes)
    banks = broadcast_banks(points, "__p", query_key.inner, rows, elements, broadcast_bytes)
    frame, inner = _inner(vectors, key, spec), spec.inner()
    found = _union([frame.mapInArrow(radius_scorer(b, inner, key, float(radius)), candidate_ddl(key, query_key))
                    for b in banks])
    return found.select(*query_key.restore(_query_names(query_key, key)), *key.restore(),
                        F.col("__d").alias(dist_col))


# ---------------------------------------------------------------- S3 / V3

def fractal_distance(df: DataFrame, query, vec="embedding", out: str = "dist",
                     options: RefineOptions | None = None, exact: bool = False) -> DataFrame:
    """S3 / V3: add the distance of every row to its query as ``out``.

    ``query`` is one constant vector or a column expression with a query per
    row.  The refined point of a constant is part of an Arrow UDF: only the
    vector column crosses to Python, all other columns stay in the JVM row.
    Queries of a column are refined once per distinct value as a job of their
    own and joined back; the distance is then a native expression.
    """
    spark = _spark(df)
    spec = VectorSpec(vec)
    if isinstance(query, Column):
        return _distance_to_column(df, query, spec, out, options, exact)
    point = refined_point(spark, query, options, exact)
    score = F.arrow_udf(point_scorer(point, spec), DoubleType())
    return df.withColumn(out, score(*[quoted(c) for c in spec.columns]))


def _distance_to_column(df, query, spec, out, options, exact):
    # the row holds the vector: it is not moved twice, and a query of floats as such
    row = df.select(F.struct(*[quoted(c) for c in df.columns]).alias("__row"), query.alias("query"))
    if row.schema["query"].dataType.simpleString() != "array<float>":
        row = row.withColumn("query", F.col("query").cast("array<double>"))
    if exact:
        points = row.withColumn("best_point", F.col("query"))
    else:
        points = refine_with_ids(row, "__row", "query", options)
    vector = _vector_column(spec, F.col("__row").getField)
    scored = points.select("__row", cosine_distance(vector, F.col("best_point")).alias("__d"))
    kept = [c for c in df.columns if c != out]
    return scored.select(*[F.col("__row").getField(c).alias(c) for c in kept], F.col("__d").alias(out))


# ---------------------------------------------------------------- S1m

def _query_names(query_key: RowKey, key: RowKey) -> list[str]:
    """Query key names of a result; one that the row key has too gets ``query_`` before it."""
    return [f"query_{n}" if n in key.names else n for n in query_key.names]


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def query_points(queries: DataFrame, query_key: RowKey, query_col: str, options, exact: bool,
                 broadcast_bytes: int) -> tuple[DataFrame, int, int]:
    """The ``(query key, __p)`` table of points to score against, its rows and elements.

    ``queries`` is evaluated once: everything later reads what was written.
    """
    spark = queries.sparkSession
    # the stored element type: kernels widen it exactly, shuffles move half the bytes
    held = materialize(queries.select(*query_key.select(), quoted(query_col).alias("query")), "queries")
    rows, elements = vector_table_size(held, "query")
    if exact:
        return held.withColumnRenamed("query", "__p"), rows, elements
    tasks = max(1, min(rows, max(2 * default_parallelism(spark), -(-rows // REFINED_PER_TASK))))
    small = fits_broadcast(rows, elements, broadcast_bytes)
    refined = refine_with_ids(held, query_key.inner, "query", options, tasks, bounded=small)
    points = refined.select(*query_key.inner, F.col("best_point").alias("__p"))
    # points that fit one broadcast are collected once, others are read part by part
    return (points if small else materialize(points, "refined")), rows, elements


def search_many(vectors: DataFrame, queries: DataFrame, k: int = 10, vec="embedding",
                id_col="id", query_id_col="query_id",
                query_col: str = "query", options: RefineOptions | None = None,
                exact: bool = False, dist_col: str = "dist",
                broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                salt_buckets: int | None = None,
                vector_broadcast_bytes: int | None = None) -> DataFrame:
    """S1m: top-k rows per query: ``(query key, rank, row key, dist)``.

    Both keys may have any type and several columns; a query key column named
    like a row key column comes back with ``query_`` before its name.  Query
    rows that repeat a key are queries of their own.  Each distinct query
    vector is refined once (R4).  Three plans with equal results, chosen by
    measured sizes against ``broadcast_bytes``:

    * query points fit: broadcast them; scan the vectors, keep a running
      top-k per query per task, then one shuffle on the query;
    * otherwise the vector table fits: broadcast the vectors; each task
      holding a batch of queries completes their top-k (no shuffle);
    * neither: the same as the first with the points cut into several
      broadcasts, one scan of the vectors each; no vector is shuffled.
    """
    _require_k(k)
    spark = _spark(vectors)
    spec, key = VectorSpec(vec), RowKey(vectors, id_col)
    query_key = RowKey(queries, query_id_col, "__k")
    points, rows, elements = query_points(queries, query_key, query_col, options, exact, broadcast_bytes)
    names = _query_names(query_key, key)

    if not fits_broadcast(rows, elements, broadcast_bytes):
        budget = broadcast_bytes if vector_broadcast_bytes is None else vector_broadcast_bytes
        planned = planned_bytes(vectors.select(*[quoted(c) for c in key.names + spec.columns]))
        # compressed files hold a few times their size; far larger ones are not even measured
        if vector_broadcast_bytes is not None or (planned is not None and planned <= budget):
            held = vectors.select(*key.select(), _vector_column(spec).alias("__p"))
            n, e = vector_table_size(held, "__p")
            if fits_broadcast(n, e, budget):
                bank = broadcast_bank(spark, collect_bank(held.orderBy(*key.order()), "__p", key.inner))
                tasks = max(2 * default_parallelism(spark), -(-rows // QUERIES_PER_TASK))
                out = points.repartition(tasks, F.xxhash64(*query_key.inner)).mapInArrow(
                    query_side_scorer(bank, k, key, query_key),
                    f"{query_key.ddl}, __r int, {key.ddl}, __d double")
                return out.select(*query_key.restore(names), F.col("__r").alias("rank"), *key.restore(),
                                  F.col("__d").alias(dist_col))

    banks = broadcast_banks(points, "__p", query_key.inner, rows, elements, broadcast_bytes)
    # every task gives k candidates a query: no more tasks than run at once
    frame, inner = _inner(vectors, key, spec).coalesce(default_parallelism(spark)), spec.inner()
    cands = _union([frame.mapInArrow(topk_scorer(b, inner, key, k), candidate_ddl(key, query_key))
                    for b in banks])
    salt = salt_buckets if salt_buckets is not None else auto_salt(planned_tasks(vectors), k)
    out = top_k_per_key(cands, ["__q"], key, k, salt)
    return out.select(*query_key.restore(names), F.col("__r").alias("rank"), *key.restore(),
                      F.col("__d").alias(dist_col))


def _vector_column(spec: VectorSpec, column=quoted):
    if spec.array_col:
        return column(spec.array_col).cast("array<double>")
    return F.array(*[column(c).cast("double") for c in spec.cols])


# ---------------------------------------------------------------- S2

def search_top_k(df: DataFrame, query, k: int = 10, by: str | None = None, vec="embedding",
                 id_col: str = "id", options: RefineOptions | None = None,
                 exact: bool = False, out: str = "top_k") -> DataFrame:
    """The top-k as one array value ``array<struct<id, dist>>`` (per group).

    The list is built from at most k selected rows per group, so the
    ``collect_list`` is bounded by k; the array is ordered by
    ``(dist NULLS LAST, id)`` inside the aggregate (NaN after numbers, as
    Spark orders doubles), with no extra window.
    """
    if by is None:
        top = search(df, query, k, vec, id_col, options, exact)
        keys = []
    else:
        top = search_groups(df, query, by, k, vec, id_col, options, exact)
        keys = [by]
    ordered = F.array_sort(F.collect_list(F.struct(
        F.col("dist").isNull().alias("n"), F.coalesce(F.col("dist"), F.lit(0.0)).alias("d"),
        F.col(id_col).alias("i"), F.col("dist").alias("dist"))))
    agg = F.transform(ordered, lambda s: F.struct(s["i"].alias(id_col), s["dist"].alias("dist")))
    if keys:
        return top.groupBy(*keys).agg(agg.alias(out))
    return top.agg(agg.alias(out))


# ---------------------------------------------------------------- S1x

def multi_probe_search(df: DataFrame, query, k: int = 10, probes: int = 5, vec="embedding",
                       id_col: str = "id", options: RefineOptions | None = None,
                       dist_col: str = "dist") -> DataFrame:
    """S1x: rank rows by their smallest distance to the ``probes`` best particles.

    The probes are R3's final population for the query, best fit first
    (ties by particle index).  ``(id, dist)`` with ``dist`` the minimum.
    """
    _require_k(k)
    if int(probes) != probes or probes < 1:
        raise ValueError(f"probes must be a positive integer, got {probes!r}")
    spark = _spark(df)
    spec = VectorSpec(vec)
    points = probe_points(spark, query, probes, options)
    key = RowKey(df, id_col)
    if points is None:
        bank = QueryBank.single(None)
        owners = None
    else:
        bank = QueryBank.from_arrays(pa.array(list(points), type=pa.list_(pa.float64())))
        # all probes share dim; one owner (the first entry) with one run
        owners = (np.array([0]), [np.array([0])], [np.array([0])])
    bank_bc = broadcast_bank(spark, bank)
    cands = _inner(df, key, spec).mapInArrow(topk_scorer(bank_bc, spec.inner(), key, k, owners=owners),
                                             candidate_ddl(key))
    return global_top_k(cands, key, k).select(*key.restore(), F.col("__d").alias(dist_col))


def probe_points(spark: SparkSession, query, probes: int,
                 options: RefineOptions | None = None):
    """The ``probes`` best particles of R3's final population for one literal
    query (best fit first, ties by particle index); folded like
    :func:`refined_point`."""
    if query is None or any(v is None for v in query):
        return None
    q = np.asarray(query, dtype=np.float64)[None, :]
    _, _, X, fit = refine(q, options or RefineOptions(), want_population=True)
    order = np.lexsort((np.arange(X.shape[1]), np.where(np.isnan(fit[0]), np.inf, fit[0])))
    return [X[0, i] for i in order[:probes]]


__all__ = [
    "search", "exact_search", "search_groups", "radius_search", "radius_many", "fractal_distance",
    "search_many", "search_top_k", "multi_probe_search", "probe_points", "refined_point",
    "with_payload",
]
