"""SQL surface: ``register(spark)`` adds the engine's functions to a session.

  fractal_search(vector, query_vector) -> DOUBLE
      cosine distance of ``vector`` to the refined point of
      ``query_vector``.  An Arrow UDF: per batch, the distinct query values
      are refined (memoised per Python worker, and seeded by the query
      bytes, so every worker gets the same point) and each row is scored
      against its own query.
  fractal_refine(query_vector) -> ARRAY<DOUBLE>
      the refined point itself (R1 in SQL), same memo and seed.
  cosine_distance(a, b) -> DOUBLE
      exact cosine distance, a SQL function (pure Catalyst expression).
  vector_valid(v, dim) -> BOOLEAN
      NULL-free vector of length ``dim``.

Usage mirrors ``SELECT id, fractal_search(embedding, :q) AS dist FROM t
ORDER BY dist LIMIT k`` with ``spark.sql(text, args={"q": [...]})``.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..operators.refine import lockstep_size
from ..operators.sfs import RefineOptions, refine
from .arrays import exact_cosine, list_dims, list_to_matrix
from ..plans.session import attach
from .vectors import cosine_distance_sql

# refined points kept per Python worker process (least recently used out)
MEMO_BYTES = 16 * 1024 * 1024
_MEMO: OrderedDict = OrderedDict()
_MEMO_USED = [0]


def _memo_get(key):
    hit = _MEMO.get(key)
    if hit is not None:
        _MEMO.move_to_end(key)
    return hit


def _memo_put(key, value):
    old = _MEMO.pop(key, None)
    if old is not None:
        _MEMO_USED[0] -= old.nbytes + len(key[0])
    _MEMO[key] = value
    _MEMO_USED[0] += value.nbytes + len(key[0])
    while _MEMO_USED[0] > MEMO_BYTES and len(_MEMO) > 1:
        k, v = _MEMO.popitem(last=False)
        _MEMO_USED[0] -= v.nbytes + len(k[0])


def refined_points(queries: np.ndarray, opts: RefineOptions) -> np.ndarray:
    """Refined point of every row of ``queries`` (Q, d), memoised."""
    okey = opts.key()
    out = np.empty_like(queries)
    missing = []
    for i, q in enumerate(queries):
        hit = _memo_get((q.tobytes(), okey))
        if hit is None:
            missing.append(i)
        else:
            out[i] = hit
    step = lockstep_size(opts, queries.shape[1])
    for lo in range(0, len(missing), step):
        part = missing[lo:lo + step]
        best, _ = refine(queries[part], opts)
        for j, i in enumerate(part):
            out[i] = best[j]
            _memo_put((queries[i].tobytes(), okey), best[j].copy())
    return out


def score_against_queries(vec: pa.Array, query: pa.Array, opts: RefineOptions | None,
                          exact: bool = False) -> pa.Array:
    """Distance of each row's vector to its own (refined) query vector."""
    n = len(vec)
    out = np.zeros(n)
    ok = np.zeros(n, dtype=bool)
    qdims = list_dims(query)
    for d in np.unique(qdims[qdims >= 0]):
        rows = np.flatnonzero(qdims == d)
        d = int(d)
        qsub = query if len(rows) == n else query.take(pa.array(rows))
        qmat, _ = list_to_matrix(qsub, d)
        if d == 0 or (qmat == qmat[0]).all():
            # the usual case: a constant query column (one literal / parameter)
            uniq, inverse = qmat[:1], np.zeros(len(rows), dtype=np.int64)
        else:
            uniq, inverse = np.unique(qmat, axis=0, return_inverse=True)
        inverse = np.asarray(inverse).reshape(-1)
        points = uniq if exact else refined_points(uniq, opts)
        vsub = vec if len(rows) == n else vec.take(pa.array(rows))
        mat, valid = list_to_matrix(vsub, d)
        if not valid.any():
            continue
        vrows = rows[valid]
        if len(uniq) == 1:
            dist = exact_cosine(mat, points[0])
        else:
            dist = exact_cosine(mat, points[inverse[valid]])
        out[vrows] = dist
        ok[vrows] = True
    return pa.array(out, type=pa.float64(), mask=~ok)


def fractal_search_udf(options: RefineOptions | None = None, exact: bool = False):
    opts = options or RefineOptions()
    attach()

    def fractal_search(vector: pa.Array, query_vector: pa.Array) -> pa.Array:
        return score_against_queries(vector, query_vector, opts, exact)

    return F.arrow_udf(fractal_search, DoubleType())


def refine_array(query: pa.Array, opts: RefineOptions) -> pa.Array:
    """Refined point of each row's query (NULL for NULL / NULL-element queries)."""
    n = len(query)
    out = [None] * n
    qdims = list_dims(query)
    for d in np.unique(qdims[qdims >= 0]):
        rows = np.flatnonzero(qdims == d)
        qmat, _ = list_to_matrix(query.take(pa.array(rows)), int(d))
        if int(d) == 0 or (qmat == qmat[0]).all():
            pts = np.repeat(refined_points(qmat[:1], opts), len(rows), axis=0)
        else:
            uniq, inverse = np.unique(qmat, axis=0, return_inverse=True)
            pts = refined_points(uniq, opts)[np.asarray(inverse).reshape(-1)]
        for j, r in enumerate(rows):
            out[r] = pts[j]
    return pa.array(out, type=pa.list_(pa.float64()))


def fractal_refine_udf(options: RefineOptions | None = None):
    opts = options or RefineOptions()
    attach()

    def fractal_refine(query_vector: pa.Array) -> pa.Array:
        return refine_array(query_vector, opts)

    return F.arrow_udf(fractal_refine, "array<double>")


def fractal_search(vector, query, options: RefineOptions | None = None):
    """Column form of the SQL function (per-row query allowed)."""
    return fractal_search_udf(options)(vector, query)


def register(spark: SparkSession, options: RefineOptions | None = None) -> list[str]:
    """Register the SQL functions on ``spark``; returns their names."""
    attach(spark)
    spark.udf.register("fractal_search", fractal_search_udf(options))
    spark.udf.register("fractal_refine", fractal_refine_udf(options))
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION cosine_distance(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) "
        "RETURNS DOUBLE RETURN " + cosine_distance_sql("a", "b"))
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION vector_valid(v ARRAY<DOUBLE>, dim INT) "
        "RETURNS BOOLEAN RETURN v IS NOT NULL AND NOT exists(v, x -> x IS NULL) "
        "AND size(v) = dim")
    return ["fractal_search", "fractal_refine", "cosine_distance", "vector_valid"]
