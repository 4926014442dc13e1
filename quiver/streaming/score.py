"""Structured Streaming (S7): score a stream of vectors against fixed queries.

Scoring is stateless (each row against constant refined points), so the
stream needs no watermark: ``readStream -> withColumn(arrow UDF) ->
writeStream`` in append mode; against several fixed queries, only matches
(within a radius) or a running top-k per query are emitted.  The running
top-k keeps k rows per query of state in a table, one version per
micro-batch (see :func:`run_stream_top_k`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scoring import VectorSpec, candidate_ddl, radius_scorer, topk_scorer
from ..operators.search import _query_names, _union, fractal_distance, query_points, refined_point
from ..operators.sfs import RefineOptions
from ..plans.bank import QueryBank, broadcast_bank, broadcast_banks
from ..plans.keys import RowKey
from ..plans.session import DEFAULT_BROADCAST_BYTES, attach, scratch_path
from ..plans.topk import global_top_k, top_k_per_key


def vector_stream(spark: SparkSession, path: str, schema=None, max_files: int | None = None) -> DataFrame:
    """A file stream of Parquet vectors (the schema is taken from the data if not given).

    A file source watches a folder; a path naming one file streams its
    folder restricted to that file name (``pathGlobFilter``).
    """
    if schema is None:
        schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    file, fs = _file_system(spark, path)
    if fs.exists(file) and fs.getFileStatus(file).isFile():
        return r.option("pathGlobFilter", file.getName()).parquet(file.getParent().toString())
    return r.parquet(path)


def _file_system(spark: SparkSession, path: str):
    """The path and its store, as Spark itself reaches them."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def score_stream(stream: DataFrame, query, vec="embedding", out: str = "dist",
                 options: RefineOptions | None = None, exact: bool = False) -> DataFrame:
    """Streaming DataFrame with the distance of every row to ``query``."""
    return fractal_distance(stream, query, vec, out, options, exact)


def run_stream_score(spark: SparkSession, stream: DataFrame, query, id_col: str,
                     vec="embedding", out_path: str | None = None,
                     checkpoint: str | None = None, options: RefineOptions | None = None,
                     available_now: bool = True):
    """Score a stream into a Parquet sink (exactly-once via the sink's log).

    Returns ``(query handle, sink path)``; with ``available_now`` the call
    processes everything present and returns after the stream stops.
    """
    out_path = out_path or scratch_path(spark, "stream-score")
    checkpoint = checkpoint or scratch_path(spark, "stream-score-ckpt")
    spec = VectorSpec(vec)
    scored = score_stream(stream.select(id_col, *spec.columns), query, vec, "dist", options)
    w = (scored.select(id_col, "dist").writeStream.format("parquet")
         .option("path", out_path).option("checkpointLocation", checkpoint)
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    handle = w.start()
    if available_now:
        handle.awaitTermination()
    return handle, out_path


def _versions(spark: SparkSession, table_path: str) -> list[int]:
    """Batch ids of the complete state versions, ascending.

    A version counts once Spark's commit marker is in its folder.  A folder
    that does not exist has none; any other trouble with the store is an error.
    """
    root, fs = _file_system(spark, table_path)
    if not fs.exists(root):
        return []
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    out = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        number = name.removeprefix("batch_id=")
        if name != number and number.isdigit() and fs.exists(marker(status.getPath(), "_SUCCESS")):
            out.append(int(number))
    return sorted(out)


def _version_path(table_path: str, batch_id: int) -> str:
    return f"{table_path.rstrip('/')}/batch_id={batch_id}"


def _drop_versions_before(spark: SparkSession, table_path: str, keep_from: int):
    """Delete state versions before ``keep_from``."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    _, fs = _file_system(spark, table_path)
    for version in _versions(spark, table_path):
        if version < keep_from:
            fs.delete(jpath(_version_path(table_path, version)), True)


def _banks_for(spark: SparkSession, queries, options: RefineOptions | None, broadcast_bytes: int,
               query_id_col="query_id", query_col: str = "query"):
    """Broadcasts of the refined queries (a literal vector or a table) and the table's key."""
    if not isinstance(queries, DataFrame):
        return [broadcast_bank(spark, QueryBank.single(refined_point(spark, queries, options)))], None
    query_key = RowKey(queries, query_id_col, "__k")
    points, rows, elements = query_points(queries, query_key, query_col, options, False, broadcast_bytes)
    return broadcast_banks(points, "__p", query_key.inner, rows, elements, broadcast_bytes), query_key


def run_stream_top_k(spark: SparkSession, stream: DataFrame, queries, k: int, id_col,
                     vec="embedding", table_path: str | None = None,
                     checkpoint: str | None = None, options: RefineOptions | None = None,
                     available_now: bool = True,
                     broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                     keep_versions: int | None = 2, query_id_col="query_id"):
    """Running top-k of a stream, kept as versioned k-rows-per-query state.

    ``queries`` is one literal vector or a ``(query_id, query)`` table
    (refined once; above ``broadcast_bytes`` it is cut into several
    broadcasts).  Keys may have any type.  Micro-batch ``b`` merges the state
    of the latest complete earlier version with its own per-task candidates
    and writes version ``b`` as a folder of its own, complete once Spark's
    commit marker is there.  A replayed batch reads the same earlier version
    and rewrites the same rows; a version that cannot be read fails the batch
    instead of starting afresh.  The answer is always one version of at most
    ``k`` rows per query, however long the stream runs.  Versions older than
    the last ``keep_versions`` are deleted after each batch (a replay only
    ever reads the version before its own); ``None`` keeps all.
    Returns ``(query handle, state path)``; read it with :func:`current_top_k`.
    """
    attach(spark)
    table_path = table_path or scratch_path(spark, "stream-topk")
    checkpoint = checkpoint or scratch_path(spark, "stream-topk-ckpt")
    spec, key = VectorSpec(vec), RowKey(stream, id_col)
    banks, query_key = _banks_for(spark, queries, options, broadcast_bytes, query_id_col)
    by = query_key.inner if query_key else ["__q"]
    ddl, inner = candidate_ddl(key, query_key), spec.inner()

    def merge(batch_df: DataFrame, batch_id: int):
        session = batch_df.sparkSession
        rows = batch_df.select(*key.select(), *spec.select())
        cands = _union([rows.mapInArrow(topk_scorer(b, inner, key, k), ddl) for b in banks])
        cands = cands.select(*by, *key.inner, "__d")
        before = [v for v in _versions(session, table_path) if v < batch_id]
        if before:
            cands = cands.unionByName(session.read.parquet(_version_path(table_path, before[-1])))
        top_k_per_key(cands, by, key, k).drop("__r").write.mode("overwrite").parquet(
            _version_path(table_path, batch_id))
        if keep_versions and before:
            # keep this version and the ones a replay could still read
            _drop_versions_before(session, table_path, min(before[-1], batch_id - keep_versions + 1))

    w = (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    handle = w.start()
    if available_now:
        handle.awaitTermination()
    return handle, table_path


def current_top_k(spark: SparkSession, table_path: str, k: int, id_col,
                  per_query: bool = False, query_id_col="query_id") -> DataFrame:
    """The latest complete state version, ordered: ``(id, dist)`` for one query, or
    ``(query_id, rank, id, dist)`` with ``per_query=True``."""
    versions = _versions(spark, table_path)
    if not versions:
        raise ValueError(f"no complete state version in {table_path}")
    state = spark.read.parquet(_version_path(table_path, versions[-1]))
    names = [id_col] if isinstance(id_col, str) else list(id_col)
    key = RowKey(state, [f"__id{i}" for i in range(len(names))])
    if not per_query:
        return global_top_k(state, key, k).select(*key.restore(names), F.col("__d").alias("dist"))
    queries = [query_id_col] if isinstance(query_id_col, str) else list(query_id_col)
    by = [c for c in state.columns if c.startswith("__k")] or ["__q"]
    return top_k_per_key(state, by, key, k).select(
        *[F.col(b).alias(n) for b, n in zip(by, queries)], F.col("__r").alias("rank"),
        *key.restore(names), F.col("__d").alias("dist"))


def run_stream_radius(spark: SparkSession, stream: DataFrame, queries, radius: float,
                      id_col, vec="embedding", out_path: str | None = None,
                      checkpoint: str | None = None, options: RefineOptions | None = None,
                      available_now: bool = True,
                      broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, query_id_col="query_id"):
    """Stateless stream matching: every (query, row) with ``dist <= radius``.

    Appends ``(query_id, id, dist)`` matches to a Parquet sink (exactly once
    through the sink's log); only matches are emitted, never all pairs.  A
    literal query has the id 0.
    """
    attach(spark)
    out_path = out_path or scratch_path(spark, "stream-radius")
    checkpoint = checkpoint or scratch_path(spark, "stream-radius-ckpt")
    spec, key = VectorSpec(vec), RowKey(stream, id_col)
    banks, query_key = _banks_for(spark, queries, options, broadcast_bytes, query_id_col)
    ddl, inner = candidate_ddl(key, query_key), spec.inner()
    rows = stream.select(*key.select(), *spec.select())
    found = _union([rows.mapInArrow(radius_scorer(b, inner, key, float(radius)), ddl) for b in banks])
    ids = query_key.restore(_query_names(query_key, key)) if query_key else [F.col("__q").alias("query_id")]
    matches = found.select(*ids, *key.restore(), F.col("__d").alias("dist"))
    w = (matches.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    handle = w.start()
    if available_now:
        handle.awaitTermination()
    return handle, out_path
