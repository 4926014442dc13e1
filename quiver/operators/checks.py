"""Checks on refinement and search results (S5, S6, S1q)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import cosine_distance, is_finite
from .refine import refine_queries
from .search import search, search_many
from .sfs import RefineOptions

# Fixed value: the convergence tolerance of the reference's smoke test.
DEFAULT_TOLERANCE = 0.01


def check_convergence(queries: DataFrame, query_col: str = "query",
                      tol: float = DEFAULT_TOLERANCE, options: RefineOptions | None = None,
                      raise_on_failure: bool = False) -> DataFrame:
    """``(query, residual, converged, status)`` per distinct query.

    ``residual = cosine_distance(query, best_point)``, i.e. what
    ``fractal_search(q, q)`` returns.  With ``raise_on_failure`` the status
    column raises when evaluated for a query whose |residual| > tol.
    """
    refined = refine_queries(queries, query_col, options)
    residual = cosine_distance(F.col("query"), F.col("best_point"))
    out = refined.select("query", residual.alias("residual"))
    ok = F.coalesce(F.abs(F.col("residual")) <= F.lit(tol), F.lit(False))
    msg = F.concat(F.lit("convergence failed: residual = "), F.col("residual").cast("string"))
    fail = F.raise_error(msg) if raise_on_failure else msg
    return (out.withColumn("converged", ok)
            .withColumn("status", F.when(ok, F.lit("convergence ok")).otherwise(fail)))


def check_search_result(result: DataFrame, k: int, dist_col: str = "dist",
                        raise_on_failure: bool = False) -> DataFrame:
    """One row ``(n, n_null, n_nonfinite, ok, status)`` for a top-k result."""
    d = F.col(dist_col)
    agg = result.agg(F.count(F.lit(1)).alias("n"),
                     F.count_if(d.isNull()).alias("n_null"),
                     F.count_if(d.isNotNull() & ~is_finite(d)).alias("n_nonfinite"))
    ok = (F.col("n") == k) & (F.col("n_null") == 0) & (F.col("n_nonfinite") == 0)
    msg = (F.when(F.col("n") != k, F.concat(F.lit(f"expected {k} top-k rows, got "),
                                            F.col("n").cast("string")))
           .when(F.col("n_null") > 0, F.lit("got NULL dist"))
           .otherwise(F.lit("got non-finite dist")))
    fail = F.raise_error(msg) if raise_on_failure else msg
    return (agg.withColumn("ok", ok)
            .withColumn("status", F.when(ok, F.concat(F.lit("search result ok: "),
                                                      F.col("n").cast("string"), F.lit(" rows")))
                        .otherwise(fail)))


def refinement_quality(vectors: DataFrame, queries: DataFrame, k: int = 10, vec="embedding",
                       id_col="id", query_id_col="query_id",
                       query_col: str = "query", options: RefineOptions | None = None,
                       **kw) -> DataFrame:
    """S1q: per query, recall@k of refined search against exact search.

    ``(query_id, hits, recall)``; both searches are S1m jobs and the overlap
    is an equi-join on ``(query_id, id)`` of k rows per query.
    """
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    by = [query_id_col] if isinstance(query_id_col, str) else list(query_id_col)
    by = [f"query_{c}" if c in ids else c for c in by]
    fr = search_many(vectors, queries, k, vec, id_col, query_id_col, query_col, options,
                     exact=False, **kw).select(*by, *ids)
    ex = search_many(vectors, queries, k, vec, id_col, query_id_col, query_col, options,
                     exact=True, **kw).select(*by, *ids)
    hits = (ex.join(fr.withColumn("_hit", F.lit(1)), [*by, *ids], "left")
            .groupBy(*by)
            .agg(F.sum(F.coalesce(F.col("_hit"), F.lit(0))).alias("hits")))
    return hits.withColumn("recall", F.col("hits") / F.lit(float(k)))


def single_query_quality(df: DataFrame, query, k: int = 10, vec="embedding", id_col: str = "id",
                         options: RefineOptions | None = None) -> DataFrame:
    """S1q for one constant query: ``(hits, recall)``."""
    fr = search(df, query, k, vec, id_col, options).select(id_col).withColumn("_hit", F.lit(1))
    ex = search(df, query, k, vec, id_col, exact=True).select(id_col)
    return (ex.join(fr, id_col, "left")
            .agg(F.sum(F.coalesce(F.col("_hit"), F.lit(0))).alias("hits"))
            .withColumn("recall", F.col("hits") / F.lit(float(k))))
