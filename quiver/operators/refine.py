"""Query refinement as Spark jobs.

``refine_queries`` deduplicates the query vectors (one refinement per
distinct query), spreads them over tasks and runs the NumPy search in a
``mapInArrow``.  Each query's random stream is seeded from its own bytes, so
recomputing a lost partition reproduces the same points.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import list_dims, list_to_matrix
from ..plans.session import attach, default_parallelism, materialize
from .sfs import RefineOptions, refine

REFINED_SCHEMA = "query array<double>, best_point array<double>, best_fit double"
POPULATION_SCHEMA = ("query array<double>, particle int, point array<double>, "
                     "fit double, is_best boolean")

# queries refined together in one lockstep call, and the cap on the
# per-generation noise block (queries x population x trials x dim doubles)
LOCKSTEP = 256
# distinct queries per refining task, where there are more than two tasks a core would hold
REFINED_PER_TASK = 2_000
# parts into which one repeated query is dealt where queries and points are joined, the rows from which a
# query counts as repeated, and how many such queries there are at most
SALT = 16
REPEATED = 10_000
REPEATED_QUERIES = 1_000
NOISE_ELEMENTS = 1 << 21


def lockstep_size(opts: RefineOptions, dim: int) -> int:
    per_query = max(1, int(opts.population) * int(opts.diffusion) * max(dim, 1))
    return max(1, min(LOCKSTEP, NOISE_ELEMENTS // per_query))


def same_numpy(version: str):
    """Random draws are only the same everywhere under one NumPy version."""
    if np.__version__ != version:
        raise RuntimeError(f"the driver has NumPy {version}, this worker {np.__version__}: "
                           "their random streams may differ")


def _chunks(qarr: pa.Array, opts: RefineOptions):
    """``(rows, matrix)`` of queries that are refined together, then the rows without a query."""
    dims = list_dims(qarr)
    for d in np.unique(dims[dims >= 0]):
        rows = np.flatnonzero(dims == d)
        step = lockstep_size(opts, int(d))
        for lo in range(0, len(rows), step):
            part = rows[lo:lo + step]
            yield part, list_to_matrix(qarr.take(pa.array(part)), int(d))[0]
    rest = np.flatnonzero(dims < 0)
    if len(rest):
        yield rest, None


def matrix_lists(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as a list array."""
    n, d = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d),
                                    pa.array(np.ascontiguousarray(rows).reshape(-1), pa.float64()))


def _refine_fn(opts: RefineOptions):
    version = np.__version__

    def run(batches):
        same_numpy(version)
        for batch in batches:
            qarr = batch.column(0).cast(pa.list_(pa.float64()))
            for rows, mat in _chunks(qarr, opts):
                query = qarr.take(pa.array(rows))
                if mat is None:
                    best, fit = pa.nulls(len(rows), pa.list_(pa.float64())), pa.nulls(len(rows), pa.float64())
                else:
                    points, fits = refine(mat, opts)
                    best, fit = matrix_lists(points), pa.array(fits, pa.float64())
                yield pa.RecordBatch.from_arrays([query, best, fit], names=["query", "best_point", "best_fit"])
    return run


def _population_fn(opts: RefineOptions):
    version = np.__version__

    def run(batches):
        same_numpy(version)
        for batch in batches:
            qarr = batch.column(0).cast(pa.list_(pa.float64()))
            for rows, mat in _chunks(qarr, opts):
                if mat is None:
                    continue
                points, fits, particles, each = refine(mat, opts, want_population=True)
                n, size, d = particles.shape
                best = (particles == points[:, None, :]).all(axis=2) & (each == fits[:, None])
                yield pa.RecordBatch.from_arrays(
                    [qarr.take(pa.array(np.repeat(rows, size))),
                     pa.array(np.tile(np.arange(size, dtype=np.int32), n)),
                     matrix_lists(particles.reshape(n * size, d)), pa.array(each.reshape(-1), pa.float64()),
                     pa.array(best.reshape(-1))],
                    names=["query", "particle", "point", "fit", "is_best"])
    return run


def distinct_queries(queries: DataFrame, query_col: str = "query",
                     parallelism: int | None = None) -> DataFrame:
    """One row per distinct query vector, spread evenly over ``parallelism`` tasks.

    The input is tiny in bytes but heavy in CPU, so it must not collapse
    into one task.  A round-robin ``repartition(n)`` balances the queries
    exactly (a hash spread leaves tasks uneven), the optimizer keeps it
    (the dedup's own partitioning does not satisfy it), and AQE never
    coalesces an explicit partition count.  Which task refines a query
    does not matter: each result depends on the query bytes alone.

    Without ``parallelism`` the distinct queries are written first and
    counted: a plan's size guess says little about them (a join's is the
    product of its sides).
    """
    spark = queries.sparkSession
    attach(spark)
    # deduplicate the stored values (float widens to double exactly and
    # one-to-one, so the distinct set is the same): the shuffles move the
    # narrow type, and the Arrow function widens to double
    once = queries.select(F.col(query_col).alias("query")).dropDuplicates(["query"])
    if parallelism is None:
        once = materialize(once, "distinct-queries")
        parallelism = _refining_tasks(spark, once.count())
    return once.repartition(parallelism)


def _refining_tasks(spark, rows: int) -> int:
    return max(1, min(rows, max(2 * default_parallelism(spark), -(-rows // REFINED_PER_TASK))))


def refine_queries(queries: DataFrame, query_col: str = "query",
                   options: RefineOptions | None = None,
                   parallelism: int | None = None) -> DataFrame:
    """``(query, best_point, best_fit)``, one row per distinct query.

    ``best_fit`` is the objective at ``best_point``: the cosine distance to
    the query (a zero norm counted as 1).  Queries that are NULL or hold a
    NULL element give NULL ``best_point`` / ``best_fit``.
    """
    opts = options or RefineOptions()
    return distinct_queries(queries, query_col, parallelism).mapInArrow(
        _refine_fn(opts), REFINED_SCHEMA)


def refine_with_ids(queries: DataFrame, id_col="query_id",
                    query_col: str = "query", options: RefineOptions | None = None,
                    parallelism: int | None = None, bounded: bool = False) -> DataFrame:
    """Refine each distinct vector once and join the points back to ids.

    Returns ``(id columns, query, best_point, best_fit)``; the join is on the
    array value (hash + equality), so equal queries share one refinement.
    ``bounded=True`` states that the caller measured the query set under a
    broadcast budget (the refined side is no larger), so the join-back is a
    broadcast hash join.  Otherwise only a query that many rows repeat is dealt
    over several parts of the join, with a copy of its point for each; other
    points are moved once.  Rows with a NULL query are spread by their ids.
    """
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    q = queries.select(*ids, F.col(query_col).alias("query"))
    have = q.filter(F.col("query").isNotNull())
    columns = [*ids, F.col("query").cast("array<double>").alias("query"), "best_point", "best_fit"]
    if not bounded:
        return _join_points(q, have, ids, options, parallelism).select(*columns)
    points = F.broadcast(refine_queries(have, "query", options, parallelism).withColumnRenamed("query", "__query"))
    found = have.join(points, F.col("query").cast("array<double>").eqNullSafe(F.col("__query")), "left")
    none = q.filter(F.col("query").isNull()).select(
        *ids, F.col("query").cast("array<double>").alias("query"),
        F.lit(None).cast("array<double>").alias("best_point"), F.lit(None).cast("double").alias("best_fit"))
    return found.select(*columns).unionByName(none)


def _join_points(q: DataFrame, have: DataFrame, ids: list[str], options: RefineOptions | None,
                 parallelism: int | None) -> DataFrame:
    """The rows of ``q`` with their points, by a join that moves every row and point once."""
    spark = q.sparkSession
    attach(spark)
    once = materialize(have.groupBy("query").agg(F.count(F.lit(1)).alias("__n")), "distinct-queries")
    size = once.agg(F.count(F.lit(1)).alias("n"), F.sum("__n").alias("rows")).first()
    often = once.filter(F.col("__n") > max(REPEATED, (size["rows"] or 0) // REPEATED_QUERIES)).select("query")
    refined = once.select("query").repartition(parallelism or _refining_tasks(spark, size["n"])).mapInArrow(
        _refine_fn(options or RefineOptions()), REFINED_SCHEMA)
    # a float widens to double and back without loss: the join moves the stored type
    kept = "array<float>" if q.schema["query"].dataType.simpleString() == "array<float>" else "array<double>"
    points = refined.withColumn("__query", F.col("query").cast(kept)).drop("query")
    dealt = q.withColumn("__key", F.col("query").cast(kept))
    part = F.lit(0).cast("long")
    if not often.isEmpty():
        many = F.broadcast(often.select(F.col("query").cast(kept).alias("__often")).distinct())
        points = points.join(many, F.col("__query").eqNullSafe(F.col("__often")), "left") \
            .withColumn("__salt", F.explode(F.sequence(part, F.when(F.col("__often").isNull(), part)
                                                       .otherwise(F.lit(SALT - 1).cast("long"))))).drop("__often")
        dealt = dealt.join(many, F.col("__key").eqNullSafe(F.col("__often")), "left")
        part = F.when(F.col("__often").isNull(), part).otherwise(F.pmod(F.xxhash64(*ids), F.lit(SALT)))
    else:
        points = points.withColumn("__salt", part)
    dealt = dealt.withColumn("__part", F.when(F.col("query").isNull(), F.xxhash64(*ids)).otherwise(part))
    return dealt.join(points, F.col("__key").eqNullSafe(F.col("__query"))
                      & (F.col("__part") == F.col("__salt")), "left")


def refinement_report(queries: DataFrame, query_col: str = "query",
                      options: RefineOptions | None = None,
                      parallelism: int | None = None) -> DataFrame:
    """R2: R1 plus a JSON text ``{"best_point": [...], "best_fit": x}`` per query."""
    refined = refine_queries(queries, query_col, options, parallelism)
    return refined.withColumn(
        "report", F.to_json(F.struct(F.col("best_point"), F.col("best_fit"))))


def explore_queries(queries: DataFrame, query_col: str = "query",
                    options: RefineOptions | None = None,
                    parallelism: int | None = None) -> DataFrame:
    """The final population, ``population`` rows per distinct query.

    ``(query, particle, point, fit, is_best)``; ``is_best`` marks the row
    equal to R1's ``best_point``.
    """
    opts = options or RefineOptions()
    return distinct_queries(queries, query_col, parallelism).mapInArrow(
        _population_fn(opts), POPULATION_SCHEMA)


def refine_local(query, options: RefineOptions | None = None):
    """Refine one query in-process (tests, oracles); same result as the job."""
    opts = options or RefineOptions()
    q = np.asarray(query, dtype=np.float64)[None, :]
    bp, bf = refine(q, opts)
    return bp[0], float(bf[0])
