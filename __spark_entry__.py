"""

``entry(spark)`` runs the flagship search on sf0.001.  ``queries()`` maps
every implemented operator to a callable ``(spark, sf_dir) -> DataFrame``
over the given tables; ``oracle_sql()`` gives the DuckDB SQL for the same
result where SQL can express it.

Oracles of refined searches embed the refined point as a literal, computed
in-process by the same kernel (same query bytes, same seed, same point).  They
check scoring and selection.  The refinement itself is checked in two ways:
``refine_search``, ``refine_local_walk`` and ``refine_free_box`` draw from the
hash stream, and their oracle runs the whole search in SQL, step by step, for
every row; the queries with default options (R1, R1b, R2, R3, S5, S1m of all
embeddings) return what can be verified from the data: points inside the box,
fits equal to recomputed distances, particle counts, ranks in order.

Distances are rounded to 6 digits on both sides; ties break by id.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiver import (RefineOptions, cosine_distance, exact_search, explore_queries,
                    fractal_distance, multi_probe_search, radius_many, radius_search, refine_with_ids,
                    pivot_search_many, refinement_report, search, search_groups, search_many, search_top_k,
                    valid_vector)
from quiver.functions.sql import register
from quiver.functions.tables import register_tables
from quiver.operators.checks import (check_convergence, check_search_result,
                                     refinement_quality)
from quiver.operators.points import PointTable
from quiver.operators.refine import refine_local
from quiver.operators.search import probe_points
from quiver.operators.setdist import min_distance_to_set, refine_against_sets
from quiver.plans.session import materialize, scratch_path
from quiver.sources.io import LINEITEM_FEATURES
from quiver.streaming.score import (current_top_k, run_stream_radius, run_stream_score,
                                    run_stream_top_k, vector_stream)

SMOKE_DIR = "/root/testdata/sf0.001"

# Query vectors of the registered searches, generated by rule (not data):
# the 64-D probe direction q[j] = sin(j + 1), a family of 8 such directions,
# and one 4-D lineitem measure vector (quantity, price, discount, tax).
DIM = 64
K = 10
GROUP_K = 5
RADIUS = 0.85
N_PROBES = 5
N_QUERIES = 8
LINEITEM_QUERY = [0.5, 0.5, 0.5, 0.5]
LINEITEM_QUERIES = {"even": LINEITEM_QUERY, "large": [0.9, 0.9, 0.1, 0.1], "taxed": [0.1, 0.2, 0.0, 0.9]}
# searches small enough for an oracle to run them in SQL for every row
HASH_DIM = 3
HASH_OPTIONS = {
    "refine_search": RefineOptions(generations=2, population=3, diffusion=2, seed=7, stream="hash"),
    "refine_local_walk": RefineOptions(generations=2, population=3, diffusion=2, walk=0.0, seed=8, stream="hash"),
    "refine_free_box": RefineOptions(generations=2, population=3, diffusion=2, lower=0.0, upper=0.5, clip=False,
                                     seed=9, stream="hash"),
}
# other options than the defaults, for whole vectors
WHOLE_OPTIONS = {
    "refine_local_walk_whole": RefineOptions(walk=0.0),
    "refine_free_box_whole": RefineOptions(lower=-0.5, upper=1.5, clip=False),
    "refine_narrow_box_whole": RefineOptions(lower=-0.25, upper=0.5),
}
# Per-measure scale of the lineitem features (the measures'
# upper ends: quantity 50, extended price 100000, discount 0.1, tax 0.08).
LINEITEM_SCALE = {"l_quantity": 50.0, "l_extendedprice": 100000.0, "l_discount": 0.1,
                  "l_tax": 0.08}
LINEITEM_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def main_query() -> list[float]:
    return [math.sin(j + 1.0) for j in range(DIM)]


def query_family() -> list[list[float]]:
    return [[math.sin((i + 1) * (j + 1) * 0.7 + i) for j in range(DIM)] for i in range(N_QUERIES)]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _r(c, name: str = "dist"):
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name)


def _family_frame(spark: SparkSession) -> DataFrame:
    rows = [(i, q) for i, q in enumerate(query_family())]
    return spark.createDataFrame(rows, "query_id long, query array<double>")


# ------------------------------------------------------------------ queries

def q_fractal_search_scalar(spark, sf):
    """V3 / S3: every embedding scored against the refined main query."""
    emb = _t(spark, sf, "embeddings")
    return fractal_distance(emb, main_query(), "embedding").select("vec_id", _r("dist"))


def q_top_k(spark, sf):
    """Top-10 nearest to the refined main query."""
    emb = _t(spark, sf, "embeddings")
    return search(emb, main_query(), K, "embedding", "vec_id").select("vec_id", _r("dist"))


def q_sql_top_k(spark, sf):
    """S1 through SQL: registered fractal_search with a bound list parameter."""
    register(spark)
    _t(spark, sf, "embeddings").createOrReplaceTempView("embeddings")
    return spark.sql(
        "SELECT vec_id, round(dist, 6) AS dist FROM ("
        " SELECT vec_id, fractal_search(CAST(embedding AS ARRAY<DOUBLE>), :q) AS dist"
        " FROM embeddings ORDER BY dist ASC NULLS LAST, vec_id LIMIT 10)",
        args={"q": main_query()})


def q_exact_top_k(spark, sf):
    """S1e: exact cosine top-10 (no refinement)."""
    emb = _t(spark, sf, "embeddings")
    return exact_search(emb, main_query(), K, vec="embedding", id_col="vec_id") \
        .select("vec_id", _r("dist"))


def q_top_k_agg(spark, sf):
    """Top-k as one array value per label, exploded for comparison."""
    emb = _t(spark, sf, "embeddings")
    agg = search_top_k(emb, main_query(), GROUP_K, by="label", vec="embedding", id_col="vec_id")
    return (agg.select("label", F.posexplode("top_k").alias("pos", "item"))
            .select("label", (F.col("pos") + 1).alias("rank"),
                    F.col("item.vec_id").alias("vec_id"), _r("item.dist")))


def q_group_top_k(spark, sf):
    """S1g: top-5 per label."""
    emb = _t(spark, sf, "embeddings")
    return search_groups(emb, main_query(), "label", GROUP_K, "embedding", "vec_id") \
        .select("label", "rank", "vec_id", _r("dist"))


def q_radius_search(spark, sf):
    """S1r: every embedding within 0.85 of the refined main query."""
    emb = _t(spark, sf, "embeddings")
    return radius_search(emb, main_query(), RADIUS, "embedding", "vec_id") \
        .select("vec_id", _r("dist"))


def q_multi_query_top_k(spark, sf):
    """S1m: top-10 per query for 8 refined queries over all embeddings."""
    emb = _t(spark, sf, "embeddings")
    return search_many(emb, _family_frame(spark), K, "embedding", "vec_id") \
        .select("query_id", "rank", "vec_id", _r("dist"))


def q_exact_self_top_k(spark, sf):
    """S1m exact, every embedding as a query against all embeddings (top-5)."""
    emb = _t(spark, sf, "embeddings")
    queries = emb.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return search_many(emb, queries, GROUP_K, "embedding", "vec_id", exact=True) \
        .select("query_id", "rank", "vec_id", _r("dist"))


def q_pivot_self_top_k(spark, sf):
    """S1m exact by the pivot join, every embedding as a query against all embeddings (top-5)."""
    emb = _t(spark, sf, "embeddings")
    return pivot_search_many(emb, _self_queries(emb), GROUP_K, "embedding", "vec_id", exact=True) \
        .select("query_id", "rank", "vec_id", _r("dist"))


def q_pivot_lineitem_top_k(spark, sf):
    """S1m exact by the pivot join: the lineitem rows most like each supplier's first one, in 4 measures."""
    li = _t(spark, sf, "lineitem")
    feats = li.select(*LINEITEM_KEY, *[(F.col(c) / F.lit(LINEITEM_SCALE[c])).alias(c) for c in LINEITEM_FEATURES])
    first = feats.groupBy("l_suppkey").agg(F.min(F.struct(*LINEITEM_KEY, *LINEITEM_FEATURES)).alias("f"))
    asked = first.select(F.col("l_suppkey").alias("query_id"),
                         F.array(*[F.col("f")[c].cast("double") for c in LINEITEM_FEATURES]).alias("query"))
    return pivot_search_many(feats, asked, GROUP_K, LINEITEM_FEATURES, LINEITEM_KEY, exact=True) \
        .select("query_id", "rank", *LINEITEM_KEY, _r("dist"))


def _self_queries(emb):
    return emb.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))


def q_self_top_k(spark, sf):
    """S1m refined, every embedding as a query against all embeddings: its top-10."""
    emb = _t(spark, sf, "embeddings")
    return search_many(emb, _self_queries(emb), K, "embedding", "vec_id") \
        .select("query_id", "rank", "vec_id", _r("dist"))


def q_self_top_k_check(spark, sf):
    """S1m refined, as above, every neighbour checked: its distance recomputed, its rank held against an exact
    search around the point that a refinement of its own gives."""
    emb = _t(spark, sf, "embeddings")
    found = search_many(emb, _self_queries(emb), K, "embedding", "vec_id")
    points = materialize(refine_with_ids(_self_queries(emb), "query_id")
                         .select("query_id", F.col("best_point").alias("query")), "points")
    true = search_many(emb, points, K, "embedding", "vec_id", exact=True) \
        .select("query_id", "rank", F.col("vec_id").alias("true_id"), F.col("dist").alias("true_dist"))
    each = (found.join(true, ["query_id", "rank"], "full")
            .join(emb.select("vec_id", "embedding"), "vec_id", "left")
            .join(points.select("query_id", F.col("query").alias("point")), "query_id"))
    return each.select("query_id", "rank", _same(F.col("dist"), cosine_distance("embedding", "point")).alias("matches"),
                       (F.col("vec_id") == F.col("true_id")).alias("true_neighbour"),
                       (F.col("dist") == F.col("true_dist")).alias("true_distance"))


def q_lineitem_top_k(spark, sf):
    """S1 over lineitem measure vectors (4-D), keyed by the lineitem row key."""
    li = _t(spark, sf, "lineitem")
    feats = li.select(*LINEITEM_KEY, *[(F.col(c) / F.lit(LINEITEM_SCALE[c])).alias(c)
                                       for c in LINEITEM_FEATURES])
    return search(feats, LINEITEM_QUERY, K, vec=LINEITEM_FEATURES, id_col=LINEITEM_KEY) \
        .select(*LINEITEM_KEY, _r("dist"))


def q_cosine_distance(spark, sf):
    """V2: exact cosine distance between consecutive embeddings (native expression)."""
    a = _t(spark, sf, "embeddings").alias("a")
    b = _t(spark, sf, "embeddings").alias("b")
    j = a.join(b, F.col("b.vec_id") == F.col("a.vec_id") + 1)
    return j.select(F.col("a.vec_id").alias("vec_id"),
                    _r(cosine_distance(F.col("a.embedding"), F.col("b.embedding"))))


def q_vector_validity(spark, sf):
    """V1: validity of each embedding (dim 64) and of its positive part (dim 32)."""
    emb = _t(spark, sf, "embeddings")
    pos = F.filter(F.col("embedding"), lambda x: x > 0)
    return emb.select("vec_id", F.size("embedding").alias("dim"),
                      valid_vector(F.col("embedding"), DIM).alias("is_valid"),
                      F.size(pos).alias("pos_dim"),
                      valid_vector(pos, DIM // 2).alias("pos_valid"))


def q_min_distance_to_set(spark, sf):
    """V4: each embedding's min(1, min cosine distance) to the label-0 embeddings."""
    emb = _t(spark, sf, "embeddings")
    members = emb.filter(F.col("label") == 0)
    return min_distance_to_set(emb, members, "embedding", "embedding", "vec_id") \
        .select("vec_id", _r("min_dist", "min_dist"))


def _in_box(point, lower=-1.0, upper=1.0):
    return F.forall(point, lambda x: (x >= F.lit(lower)) & (x <= F.lit(upper)))


def _same(a, b):
    return F.abs(a - b) <= F.lit(1e-9)


def q_refine_queries(spark, sf):
    """R1 + R4: every embedding refined as a query (one search per distinct vector)."""
    emb = _t(spark, sf, "embeddings")
    r = refine_with_ids(emb.select("vec_id", F.col("embedding").alias("query")), "vec_id")
    return r.select("vec_id", F.size("best_point").alias("dim"), _in_box("best_point").alias("in_box"),
                    _same(F.col("best_fit"), cosine_distance("query", "best_point")).alias("fit_matches"),
                    (F.col("best_fit") < 0.5).alias("improved"))


def _refined_whole(spark, sf, options):
    """Every embedding refined with other options: default population, generations and trials, all 64 components."""
    emb = _t(spark, sf, "embeddings")
    r = refine_with_ids(emb.select("vec_id", F.col("embedding").alias("query")), "vec_id", options=options)
    lower, upper = float(options.lower), float(options.upper)
    start = F.transform("query", lambda x: F.lit((lower + upper) / 2.0))
    return r.select("vec_id", F.size("best_point").alias("dim"), _in_box("best_point", lower, upper).alias("in_box"),
                    _same(F.col("best_fit"), cosine_distance("query", "best_point")).alias("fit_matches"),
                    (F.col("best_fit") < F.least(F.lit(1.0), cosine_distance("query", start))).alias("improved"))


def q_refine_local_walk_whole(spark, sf):
    """R1d with ``walk <= 0`` over whole vectors."""
    return _refined_whole(spark, sf, WHOLE_OPTIONS["refine_local_walk_whole"])


def q_refine_free_box_whole(spark, sf):
    """Another search box, without clipping, over whole vectors."""
    return _refined_whole(spark, sf, WHOLE_OPTIONS["refine_free_box_whole"]).drop("in_box")


def q_refine_narrow_box_whole(spark, sf):
    """Another search box, with clipping, over whole vectors."""
    return _refined_whole(spark, sf, WHOLE_OPTIONS["refine_narrow_box_whole"])


def q_point_table(spark, sf):
    """R4 across queries: points kept by one call serve the next, which refines the new queries only."""
    emb = _t(spark, sf, "embeddings")
    kept = PointTable(spark, scratch_path(spark, "kept-points"))
    kept.refine(emb.filter("vec_id % 10 <> 0"), "embedding")
    first = kept.known().select("query", F.lit(True).alias("was_kept"))
    points = kept.refine(emb, "embedding")
    own = emb.select("vec_id", F.col("embedding").cast("array<double>").alias("query"))
    fresh = refine_with_ids(own, "vec_id").select("vec_id", F.col("best_point").alias("fresh"))
    return (own.join(points, "query").join(first, "query", "left").join(fresh, "vec_id")
            .select("vec_id", F.coalesce("was_kept", F.lit(False)).alias("was_kept"),
                    (F.col("best_point") == F.col("fresh")).alias("same_point"),
                    _same(F.col("best_fit"), cosine_distance("query", "best_point")).alias("fit_matches")))


def _sql_point(spark):
    """The refined main query in the session variable ``search_point``, by one job."""
    spark.sql("DECLARE OR REPLACE VARIABLE search_point ARRAY<DOUBLE>")
    spark.sql("SET VARIABLE search_point = (SELECT best_point FROM fractal_points(TABLE(SELECT "
              "CAST(:q AS ARRAY<DOUBLE>) AS query)))", args={"q": main_query()})


def q_sql_point_top_k(spark, sf):
    """V3 / R4 in SQL: the constant query refined once by a job, its point a session variable."""
    register_tables(spark)
    _t(spark, sf, "embeddings").createOrReplaceTempView("embeddings")
    _sql_point(spark)
    return spark.sql("SELECT vec_id, round(dist, 6) AS dist FROM (SELECT vec_id, nearest_distance("
                     "CAST(embedding AS ARRAY<DOUBLE>), search_point) AS dist FROM embeddings "
                     f"ORDER BY dist ASC NULLS LAST, vec_id LIMIT {K})")


def q_sql_top_k_agg(spark, sf):
    """S2 in SQL, two steps: k rows per task and group, then the aggregate."""
    register_tables(spark)
    _t(spark, sf, "embeddings").createOrReplaceTempView("embeddings")
    _sql_point(spark)
    return spark.sql(
        "SELECT label, CAST(pos + 1 AS INT) AS rank, item.vec_id AS vec_id, round(item.dist, 6) AS dist FROM ("
        f"SELECT label, nearest_top_k(top_k, {GROUP_K}) AS top_k FROM nearest_parts(TABLE(SELECT label, vec_id, "
        f"CAST(embedding AS ARRAY<DOUBLE>) FROM embeddings), search_point, {GROUP_K}) GROUP BY label) "
        "LATERAL VIEW posexplode(top_k) AS pos, item")


def q_sql_top_k_agg_groups(spark, sf):
    """S2 in SQL with two group columns and a string id."""
    register_tables(spark, groups="label int, half string", id_ddl="name string")
    _t(spark, sf, "embeddings").createOrReplaceTempView("embeddings")
    _sql_point(spark)
    return spark.sql(
        "SELECT label, half, CAST(pos + 1 AS INT) AS rank, item.name AS name, round(item.dist, 6) AS dist FROM ("
        f"SELECT label, half, nearest_top_k(top_k, {GROUP_K}) AS top_k FROM nearest_parts(TABLE(SELECT label, "
        "IF(vec_id % 2 = 0, 'even', NULL) AS half, CONCAT('v', vec_id) AS name, CAST(embedding AS ARRAY<DOUBLE>) "
        f"FROM embeddings), search_point, {GROUP_K}) GROUP BY label, half) LATERAL VIEW posexplode(top_k) AS pos, item")


def q_sql_top_k_agg_direct(spark, sf):
    """S2 in SQL in one step, as an aggregate over rows with a bound list parameter."""
    register_tables(spark)
    _t(spark, sf, "embeddings").createOrReplaceTempView("embeddings")
    return spark.sql(
        "SELECT label, CAST(pos + 1 AS INT) AS rank, item.vec_id AS vec_id, round(item.dist, 6) AS dist FROM ("
        f"SELECT label, fractal_search_top_k(CAST(embedding AS ARRAY<DOUBLE>), vec_id, :q, {GROUP_K}) AS top_k "
        "FROM embeddings GROUP BY label) LATERAL VIEW posexplode(top_k) AS pos, item", args={"q": main_query()})


SQL_POINTS = ("SELECT * FROM {f}(TABLE(SELECT /*+ REPARTITION(64) */ DISTINCT CAST(embedding AS ARRAY<DOUBLE>) "
              "AS query FROM embeddings))")


def q_sql_column_search(spark, sf):
    """V3 in SQL with a query per row: each distinct query refined once in a table that the rows are joined to."""
    register_tables(spark)
    register(spark)
    _t(spark, sf, "embeddings").createOrReplaceTempView("embeddings")
    return spark.sql(
        f"WITH points AS ({SQL_POINTS.format(f='fractal_points')}), pairs AS ("
        "SELECT a.vec_id, CAST(a.embedding AS ARRAY<DOUBLE>) AS v, CAST(b.embedding AS ARRAY<DOUBLE>) AS query "
        "FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1) "
        "SELECT vec_id, round(cosine_distance(v, query), 6) AS exact, "
        "abs(acos(greatest(-1D, least(1D, 1 - nearest_distance(v, best_point)))) "
        "- acos(greatest(-1D, least(1D, 1 - cosine_distance(v, query))))) "
        "<= acos(greatest(-1D, least(1D, 1 - best_fit))) + 1e-6D AS within_residual "
        "FROM pairs JOIN points USING (query)")


def q_sql_population(spark, sf):
    """R3 as a table function: the final population of every distinct embedding, every fit recomputed."""
    register_tables(spark)
    register(spark)
    _t(spark, sf, "embeddings").createOrReplaceTempView("embeddings")
    return spark.sql(
        "SELECT round(query[0], 6) AS q1, count(*) AS particles, count_if(is_best) AS n_best, "
        "count_if(abs(fit - cosine_distance(query, point)) <= 1e-9D AND forall(point, x -> abs(x) <= 1)) AS n_ok, "
        "min(fit) = min(IF(is_best, fit, NULL)) AS best_is_least "
        f"FROM ({SQL_POINTS.format(f='fractal_population')}) GROUP BY query")


def _refine_by_hash(spark, sf, options):
    """Every embedding's first three components refined with the hash stream."""
    emb = _t(spark, sf, "embeddings")
    q = emb.select("vec_id", F.slice("embedding", 1, HASH_DIM).alias("query"))
    r = refine_with_ids(q, "vec_id", options=options)
    return r.select("vec_id", _r("best_fit", "best_fit"),
                    *[_r(F.element_at("best_point", j + 1), f"p{j + 1}") for j in range(HASH_DIM)])


def q_refine_search(spark, sf):
    """R1, R1a, R1d: the search itself, checked step by step in SQL."""
    return _refine_by_hash(spark, sf, HASH_OPTIONS["refine_search"])


def q_refine_local_walk(spark, sf):
    """R1d with ``walk <= 0``: local noise around each particle."""
    return _refine_by_hash(spark, sf, HASH_OPTIONS["refine_local_walk"])


def q_refine_free_box(spark, sf):
    """Another search box, without clipping."""
    return _refine_by_hash(spark, sf, HASH_OPTIONS["refine_free_box"])


def q_refinement_report(spark, sf):
    """R2: JSON report per distinct embedding query, parsed and compared with R1's columns."""
    emb = _t(spark, sf, "embeddings")
    r = refinement_report(emb, "embedding")
    told = F.from_json("report", "best_point array<double>, best_fit double")
    return r.select(_r(F.element_at("query", 1), "q1"), F.size(told["best_point"]).alias("dim"),
                    (told["best_point"] == F.col("best_point")).alias("same_point"),
                    _same(told["best_fit"], cosine_distance("query", told["best_point"])).alias("fit_matches"))


def q_explore_queries(spark, sf):
    """Final population (50 particles) per distinct embedding query, every fit recomputed."""
    emb = _t(spark, sf, "embeddings")
    r = explore_queries(emb, "embedding").withColumn(
        "ok", _in_box("point") & _same(F.col("fit"), cosine_distance("query", "point")))
    return (r.groupBy("query").agg(F.count(F.lit(1)).alias("particles"), F.count_if("is_best").alias("n_best"),
                                   F.count_if("ok").alias("n_ok"),
                                   (F.min("fit") == F.min(F.when(F.col("is_best"), F.col("fit")))).alias("best_is_least"))
            .select(_r(F.element_at("query", 1), "q1"), "particles", "n_best", "n_ok", "best_is_least"))


def q_refine_against_sets(spark, sf):
    """Per label, a point refined against the label's set of embeddings."""
    emb = _t(spark, sf, "embeddings")
    r = refine_against_sets(emb, "label", "embedding")
    near = (emb.select("label", "embedding").join(r, "label")
            .groupBy("label").agg(F.min(cosine_distance("embedding", "best_point")).alias("near")))
    return (r.join(near, "label")
            .select("label", "dim", _in_box("best_point").alias("in_box"),
                    _same(F.col("best_fit"), F.least(F.lit(1.0), "near")).alias("fit_matches"),
                    (F.col("best_fit") < 0.5).alias("improved")))


def q_fractal_search_column(spark, sf):
    """V3 with a per-row query: each embedding against a query of the family, by its id."""
    emb = _t(spark, sf, "embeddings")
    family = F.array(*[F.array(*[F.lit(x) for x in q]) for q in query_family()])
    own = F.element_at(family, (F.pmod("vec_id", F.lit(N_QUERIES)) + 1).cast("int"))
    return fractal_distance(emb, own).select("vec_id", _r("dist"))


def q_fractal_search_consecutive(spark, sf):
    """V3 with as many queries as rows: each embedding against the next one's own refined point.

    ``matches``: the distance is that to the point refined apart from it;
    ``within_residual``: its angle differs from the exact one by no more than
    the refinement's residual.
    """
    emb = _t(spark, sf, "embeddings")
    after = emb.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("query"))
    pairs = emb.select("vec_id", "embedding").join(after, "vec_id")
    scored = fractal_distance(pairs, F.col("query"))
    points = refine_with_ids(after, "vec_id").select("vec_id", "best_point", "best_fit")
    exact = cosine_distance("embedding", "query")

    def angle(d):
        return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 1 - d)))

    return scored.join(points, "vec_id").select(
        "vec_id", _r(exact, "exact"), _same(F.col("dist"), cosine_distance("embedding", "best_point")).alias("matches"),
        (F.abs(angle(F.col("dist")) - angle(exact)) <= angle(F.col("best_fit")) + F.lit(1e-6)).alias("within_residual"))


def q_radius_many(spark, sf):
    """S1r for a query table: all embeddings within 0.85 of each refined family query."""
    emb = _t(spark, sf, "embeddings")
    return radius_many(emb, _family_frame(spark), RADIUS, "embedding", "vec_id") \
        .select("query_id", "vec_id", _r("dist"))


def q_lineitem_multi_top_k(spark, sf):
    """S1m with a four-column row key: the top-10 lineitem rows of three measure vectors."""
    li = _t(spark, sf, "lineitem")
    feats = li.select(*LINEITEM_KEY, *[(F.col(c) / F.lit(LINEITEM_SCALE[c])).alias(c)
                                       for c in LINEITEM_FEATURES])
    qs = spark.createDataFrame(list(LINEITEM_QUERIES.items()), "query_id string, query array<double>")
    return search_many(feats, qs, K, LINEITEM_FEATURES, LINEITEM_KEY) \
        .select("query_id", "rank", *LINEITEM_KEY, _r("dist"))


def q_multi_probe(spark, sf):
    """S1x: top-10 by the smallest distance to the 5 best particles."""
    emb = _t(spark, sf, "embeddings")
    return multi_probe_search(emb, main_query(), K, N_PROBES, "embedding", "vec_id") \
        .select("vec_id", _r("dist"))


def q_refinement_quality(spark, sf):
    """S1q: recall@10 of refined against exact search for the 8 queries."""
    emb = _t(spark, sf, "embeddings")
    return refinement_quality(emb, _family_frame(spark), K, "embedding", "vec_id") \
        .select("query_id", "hits", "recall")


def q_convergence_check(spark, sf):
    """Residual of every embedding used as a query (64-D: not expected < 0.01), and of their first two components."""
    emb = _t(spark, sf, "embeddings")
    wide = check_convergence(emb, "embedding")
    flat = check_convergence(emb.select(F.slice("embedding", 1, 2).alias("embedding")), "embedding")
    return (wide.unionByName(flat)
            .select(_r(F.element_at("query", 1), "q1"), F.size("query").alias("dim"),
                    (F.col("converged") == (F.abs("residual") <= 0.01)).alias("consistent"),
                    ((F.size("query") > 2) | F.col("converged")).alias("flat_converges")))


def q_result_check(spark, sf):
    """Count / NULL / finite checks on the S1 result."""
    emb = _t(spark, sf, "embeddings")
    top = search(emb, main_query(), K, "embedding", "vec_id")
    return check_search_result(top, K).select("n", "n_null", "n_nonfinite", "ok")


def q_stream_score(spark, sf):
    """Embeddings replayed as a file stream, scored into a Parquet sink."""
    stream = vector_stream(spark, f"{sf}/embeddings.parquet")
    _, path = run_stream_score(spark, stream, main_query(), "vec_id", "embedding")
    return spark.read.parquet(path).select("vec_id", _r("dist"))


def q_stream_top_k(spark, sf):
    """S7 running top-k: per-micro-batch candidates merged by batch id."""
    stream = vector_stream(spark, f"{sf}/embeddings.parquet")
    _, path = run_stream_top_k(spark, stream, main_query(), K, "vec_id", "embedding")
    return current_top_k(spark, path, K, "vec_id").select("vec_id", _r("dist"))


def q_stream_multi_top_k(spark, sf):
    """S7 against fixed queries: running top-10 per query of the 8-query family."""
    stream = vector_stream(spark, f"{sf}/embeddings.parquet")
    _, path = run_stream_top_k(spark, stream, _family_frame(spark), K, "vec_id", "embedding")
    return current_top_k(spark, path, K, "vec_id", per_query=True) \
        .select("query_id", "rank", "vec_id", _r("dist"))


def q_stream_radius(spark, sf):
    """S7 stateless matching: stream rows within 0.85 of the refined main query."""
    stream = vector_stream(spark, f"{sf}/embeddings.parquet")
    q = spark.createDataFrame([(0, main_query())], "query_id long, query array<double>")
    _, path = run_stream_radius(spark, stream, q, RADIUS, "vec_id", "embedding")
    return spark.read.parquet(path).select("vec_id", _r("dist"))


def _llm() -> tuple[dict, dict]:
    """Queries and SQL of the ``llm`` subpackage and its pipeline, where they exist."""
    try:
        import corpus_pipeline
        from quiver.llm import queries as llm
    except ModuleNotFoundError as e:
        if e.name in ("corpus_pipeline", "quiver.llm"):
            return {}, {}
        raise
    sql = dict(llm.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, sql


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top-10 embeddings nearest to the refined main query, sf0.001."""
    return q_top_k(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {
        "fractal_search_scalar": q_fractal_search_scalar,
        "fractal_search_column": q_fractal_search_column,
        "fractal_search_consecutive": q_fractal_search_consecutive,
        "top_k": q_top_k,
        "sql_top_k": q_sql_top_k,
        "exact_top_k": q_exact_top_k,
        "top_k_agg": q_top_k_agg,
        "group_top_k": q_group_top_k,
        "radius_search": q_radius_search,
        "multi_query_top_k": q_multi_query_top_k,
        "exact_self_top_k": q_exact_self_top_k,
        "self_top_k": q_self_top_k,
        "lineitem_top_k": q_lineitem_top_k,
        "cosine_distance": q_cosine_distance,
        "vector_validity": q_vector_validity,
        "min_distance_to_set": q_min_distance_to_set,
        "lineitem_multi_top_k": q_lineitem_multi_top_k,
        "radius_many": q_radius_many,
        "refine_queries": q_refine_queries,
        "refine_search": q_refine_search,
        "refine_local_walk": q_refine_local_walk,
        "refine_free_box": q_refine_free_box,
        "refinement_report": q_refinement_report,
        "explore_queries": q_explore_queries,
        "refine_against_sets": q_refine_against_sets,
        "multi_probe": q_multi_probe,
        "refinement_quality": q_refinement_quality,
        "convergence_check": q_convergence_check,
        "result_check": q_result_check,
        "stream_score": q_stream_score,
        "stream_top_k": q_stream_top_k,
        "stream_multi_top_k": q_stream_multi_top_k,
        "stream_radius": q_stream_radius,
        "self_top_k_check": q_self_top_k_check,
        "refine_local_walk_whole": q_refine_local_walk_whole,
        "refine_free_box_whole": q_refine_free_box_whole,
        "refine_narrow_box_whole": q_refine_narrow_box_whole,
        "point_table": q_point_table,
        "sql_point_top_k": q_sql_point_top_k,
        "sql_top_k_agg": q_sql_top_k_agg,
        "sql_top_k_agg_groups": q_sql_top_k_agg_groups,
        "sql_top_k_agg_direct": q_sql_top_k_agg_direct,
        "sql_column_search": q_sql_column_search,
        "sql_population": q_sql_population,
        "pivot_self_top_k": q_pivot_self_top_k,
        "pivot_lineitem_top_k": q_pivot_lineitem_top_k,
    }
    out.update(_llm()[0])
    return out


# ------------------------------------------------------------------ oracles

def _lit(vec) -> str:
    return "[" + ", ".join(repr(float(x)) for x in vec) + "]::DOUBLE[]"


def _dist(e: str, p: str) -> str:
    """DuckDB cosine distance with the engine's NULL / length / zero-norm rules."""
    return (f"(CASE WHEN {e} IS NULL OR {p} IS NULL OR len({e}) <> len({p}) "
            f"OR list_count({e}) <> len({e}) OR list_count({p}) <> len({p}) THEN NULL::DOUBLE "
            f"WHEN list_dot_product({e}, {e}) = 0 OR list_dot_product({p}, {p}) = 0 THEN 1.0::DOUBLE "
            f"ELSE 1.0::DOUBLE - list_dot_product({e}, {p}) / "
            f"(sqrt(list_dot_product({e}, {e})) * sqrt(list_dot_product({p}, {p}))) END)")


def _search_sql(o: RefineOptions) -> str:
    """The search over every embedding's first components, one trial per recursion step.

    Uniform number e of the stream is an integer hash of e; a normal takes two.
    """
    size, trials, dim = o.population, o.diffusion, HASH_DIM
    lo, hi = float(o.lower), float(o.upper)
    steps = o.generations * size * trials

    def u(e):
        return (f"((((({o.seed} + 7919 * (({e}) + 1)) % 2147483647) * 16807 % 2147483647 + ({e})) * 48271) "
                f"% 2147483647 / 2147483647::DOUBLE)")

    def norm(v):
        return f"(CASE WHEN list_dot_product({v}, {v}) = 0 THEN 1.0::DOUBLE ELSE sqrt(list_dot_product({v}, {v})) END)"

    def fit(v):
        return f"(1.0::DOUBLE - list_dot_product({v}, q) / ({norm('q')} * {norm(v)}))"

    first = f"({size * dim} + 2 * (s * {dim} + j - 1))"     # trials use the stream in step order
    z = f"(sqrt(-2 * ln(greatest({u(first)}, 1e-300::DOUBLE))) * cos(2 * pi() * {u(first + ' + 1')}))"
    at = f"x[(s // {trials}) % {size} + 1]"
    if o.walk > 0:
        move = f"base[j] + {z} * {float(o.walk)!r}::DOUBLE * (base[j] - {at}[j])"
    else:
        move = f"{at}[j] + {z} * {0.01 * (hi - lo)!r}::DOUBLE"
    if o.clip:
        move = f"least({hi!r}::DOUBLE, greatest({lo!r}::DOUBLE, {move}))"
    mine = f"(s // {trials}) % {size} + 1"
    return f"""
WITH RECURSIVE queries AS (
  SELECT vec_id, embedding[1:{dim}]::DOUBLE[] AS q FROM embeddings),
drawn AS (
  SELECT vec_id, q, list_transform(range(0, {size}), lambda i: list_transform(range(1, {dim + 1}),
    lambda j: {lo!r}::DOUBLE + {u(f'i * {dim} + j - 1')} * {hi - lo!r}::DOUBLE)) AS x FROM queries),
scored AS (
  SELECT vec_id, q, x, list_transform(x, lambda v: {fit('v')}) AS f FROM drawn),
search AS (
  SELECT vec_id, q, 0::BIGINT AS s, x, f, list_position(f, list_min(f))::BIGINT AS b,
         x[list_position(f, list_min(f))] AS base FROM scored
  UNION ALL
  SELECT vec_id, q, s + 1, nx, nf, nb,
         CASE WHEN (s + 1) % {trials} = 0 THEN nx[nb] ELSE base END
  FROM (
    SELECT *, CASE WHEN ft < f[{mine}] AND ft < f[b] THEN {mine} ELSE b END AS nb,
           list_transform(range(1, {size + 1}), lambda p: CASE WHEN p = {mine} AND ft < f[p] THEN t ELSE x[p] END) AS nx,
           list_transform(range(1, {size + 1}), lambda p: CASE WHEN p = {mine} AND ft < f[p] THEN ft ELSE f[p] END) AS nf
    FROM (SELECT *, {fit('t')} AS ft
          FROM (SELECT *, list_transform(range(1, {dim + 1}), lambda j: {move}) AS t FROM search WHERE s < {steps}))))
SELECT vec_id, round(f[b], 6) AS best_fit, {', '.join(f'round(x[b][{j + 1}], 6) AS p{j + 1}' for j in range(dim))}
FROM search WHERE s = {steps}"""


@lru_cache(maxsize=None)
def _refined(query: tuple) -> tuple:
    return tuple(refine_local(list(query), RefineOptions())[0])


def _probes() -> list:
    from quiver.operators.sfs import refine
    import numpy as np
    _, _, X, fit = refine(np.asarray([main_query()]), RefineOptions(), want_population=True)
    order = np.lexsort((np.arange(X.shape[1]), fit[0]))[:N_PROBES]
    return [X[0, i] for i in order]


E = "embedding::DOUBLE[]"


def _rnd(x: str) -> str:
    """round to 6 digits; adding 0.0 maps -0.0 to 0.0 as Spark's round does."""
    return f"(round({x}, 6) + 0.0::DOUBLE)"


def oracle_sql() -> dict[str, str]:
    p_main = _lit(_refined(tuple(main_query())))
    q_main = _lit(main_query())
    d_main = _dist(E, "q.p")
    fam_vals = ", ".join(f"(CAST({i} AS BIGINT), {_lit(_refined(tuple(q)))}, {_lit(q)})"
                         for i, q in enumerate(query_family()))
    fam = f"fam(query_id, p, raw) AS (VALUES {fam_vals})"
    li_vec = "[" + ", ".join(f"({c}::DOUBLE / {LINEITEM_SCALE[c]!r})" for c in LINEITEM_FEATURES) + "]"
    li_key = ", ".join(LINEITEM_KEY)
    probes = _probes()
    probe_cols = ", ".join(f"{_lit(p)} AS p{i}" for i, p in enumerate(probes))
    probe_dist = "least(" + ", ".join(_dist(E, f"q.p{i}") for i in range(len(probes))) + ")"

    top_k = (f"WITH q AS (SELECT {p_main} AS p), s AS (SELECT vec_id, {d_main} AS dist "
             f"FROM embeddings, q) SELECT vec_id, {_rnd('dist')} AS dist FROM s "
             f"ORDER BY dist ASC NULLS LAST, vec_id LIMIT {K}")
    group = (f"WITH q AS (SELECT {p_main} AS p), s AS (SELECT label, vec_id, {d_main} AS dist "
             f"FROM embeddings, q), r AS (SELECT label, vec_id, dist, CAST(row_number() OVER "
             f"(PARTITION BY label ORDER BY dist ASC NULLS LAST, vec_id) AS INTEGER) AS rank FROM s) "
             f"SELECT label, rank, vec_id, {_rnd('dist')} AS dist FROM r WHERE rank <= {GROUP_K}")
    scalar = (f"WITH q AS (SELECT {p_main} AS p) SELECT vec_id, {_rnd(d_main)} AS dist "
              f"FROM embeddings, q")
    out = {
        "fractal_search_scalar": scalar,
        "top_k": top_k,
        "sql_top_k": top_k,
        "exact_top_k": top_k.replace(p_main, q_main),
        "top_k_agg": group,
        "group_top_k": group,
        "radius_search": (f"WITH q AS (SELECT {p_main} AS p), s AS (SELECT vec_id, {d_main} AS dist "
                          f"FROM embeddings, q) SELECT vec_id, {_rnd('dist')} AS dist FROM s "
                          f"WHERE dist <= {RADIUS}"),
        "multi_query_top_k": (
            f"WITH {fam}, s AS (SELECT fam.query_id, e.vec_id, {_dist('e.embedding::DOUBLE[]', 'fam.p')} "
            f"AS dist FROM embeddings e, fam), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY "
            f"query_id ORDER BY dist ASC NULLS LAST, vec_id) AS INTEGER) AS rank FROM s) "
            f"SELECT query_id, rank, vec_id, {_rnd('dist')} AS dist FROM r WHERE rank <= {K}"),
        "exact_self_top_k": (
            f"WITH s AS (SELECT a.vec_id AS query_id, b.vec_id, "
            f"{_dist('b.embedding::DOUBLE[]', 'a.embedding::DOUBLE[]')} AS dist "
            f"FROM embeddings a, embeddings b), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY "
            f"query_id ORDER BY dist ASC NULLS LAST, vec_id) AS INTEGER) AS rank FROM s) "
            f"SELECT query_id, rank, vec_id, {_rnd('dist')} AS dist FROM r WHERE rank <= {GROUP_K}"),
        "lineitem_top_k": (
            f"WITH q AS (SELECT {_lit(_refined(tuple(LINEITEM_QUERY)))} AS p), s AS (SELECT {li_key}, "
            f"{_dist(li_vec, 'q.p')} AS dist FROM lineitem, q) SELECT {li_key}, {_rnd('dist')} AS dist "
            f"FROM s ORDER BY dist ASC NULLS LAST, {li_key} LIMIT {K}"),
        "cosine_distance": (
            f"SELECT a.vec_id, {_rnd(_dist('b.embedding::DOUBLE[]', 'a.embedding::DOUBLE[]'))} "
            f"AS dist FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"),
        "vector_validity": (
            "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim, (embedding IS NOT NULL AND "
            f"list_count(embedding) = len(embedding) AND len(embedding) = {DIM}) AS is_valid, "
            "CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS pos_dim, "
            f"(len(list_filter(embedding, lambda x: x > 0)) = {DIM // 2}) AS pos_valid FROM embeddings"),
        "min_distance_to_set": (
            f"SELECT a.vec_id, {_rnd('least(1.0::DOUBLE, min(' + _dist('a.embedding::DOUBLE[]', 'b.embedding::DOUBLE[]') + '))')} "
            f"AS min_dist FROM embeddings a, (SELECT embedding FROM embeddings WHERE label = 0) b "
            f"GROUP BY a.vec_id"),
        "multi_probe": (
            f"WITH q AS (SELECT {probe_cols}), s AS (SELECT vec_id, {probe_dist} AS dist "
            f"FROM embeddings, q) SELECT vec_id, {_rnd('dist')} AS dist FROM s "
            f"ORDER BY dist ASC NULLS LAST, vec_id LIMIT {K}"),
        "refinement_quality": (
            f"WITH {fam}, s AS (SELECT fam.query_id, e.vec_id, "
            f"{_dist('e.embedding::DOUBLE[]', 'fam.p')} AS d_ref, "
            f"{_dist('e.embedding::DOUBLE[]', 'fam.raw')} AS d_ex FROM embeddings e, fam), "
            f"r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d_ref ASC NULLS LAST, "
            f"vec_id) AS rr, row_number() OVER (PARTITION BY query_id ORDER BY d_ex ASC NULLS LAST, "
            f"vec_id) AS re FROM s) SELECT query_id, CAST(sum(CASE WHEN rr <= {K} AND re <= {K} THEN 1 "
            f"ELSE 0 END) AS BIGINT) AS hits, sum(CASE WHEN rr <= {K} AND re <= {K} THEN 1 ELSE 0 END) / "
            f"{float(K)} AS recall FROM r GROUP BY query_id"),
        "result_check": (
            f"WITH t AS ({top_k}) SELECT count(*) AS n, CAST(count_if(dist IS NULL) AS BIGINT) AS n_null, "
            f"CAST(count_if(dist IS NOT NULL AND NOT isfinite(dist)) AS BIGINT) AS n_nonfinite, "
            f"(count(*) = {K} AND count_if(dist IS NULL) = 0 AND "
            f"count_if(dist IS NOT NULL AND NOT isfinite(dist)) = 0) AS ok FROM t"),
        "stream_score": scalar,
        "stream_top_k": top_k,
    }
    first = "round(embedding[1]::DOUBLE, 6) AS q1"
    each = "(SELECT DISTINCT embedding FROM embeddings)"
    out |= {name: _search_sql(options) for name, options in HASH_OPTIONS.items()}
    out |= {
        "refine_queries": "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim, true AS in_box, "
                          "true AS fit_matches, true AS improved FROM embeddings",
        "refinement_report": f"SELECT {first}, CAST(len(embedding) AS INTEGER) AS dim, true AS same_point, "
                             f"true AS fit_matches FROM {each}",
        "explore_queries": f"SELECT {first}, 50::BIGINT AS particles, 1::BIGINT AS n_best, 50::BIGINT AS n_ok, "
                           f"true AS best_is_least FROM {each}",
        "refine_against_sets": f"SELECT DISTINCT label, {DIM} AS dim, true AS in_box, true AS fit_matches, "
                               "true AS improved FROM embeddings",
        "convergence_check": f"SELECT {first}, CAST(len(embedding) AS INTEGER) AS dim, true AS consistent, "
                             f"true AS flat_converges FROM {each} UNION ALL SELECT {first}, 2, true, true "
                             "FROM (SELECT DISTINCT embedding[1:2] AS embedding FROM embeddings)",
        "self_top_k_check": "SELECT vec_id AS query_id, CAST(rank AS INTEGER) AS rank, true AS matches, "
                            f"true AS true_neighbour, true AS true_distance FROM embeddings, range(1, {K + 1}) r(rank) "
                            "WHERE rank <= (SELECT count(*) FROM embeddings)",
        "point_table": "SELECT vec_id, vec_id % 10 <> 0 AS was_kept, true AS same_point, true AS fit_matches FROM embeddings",
        "sql_population": f"SELECT {first}, 50::BIGINT AS particles, 1::BIGINT AS n_best, 50::BIGINT AS n_ok, "
                          f"true AS best_is_least FROM {each}",
        "sql_column_search": (
            f"SELECT a.vec_id, {_rnd(_dist('b.embedding::DOUBLE[]', 'a.embedding::DOUBLE[]'))} AS exact, "
            "true AS within_residual FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"),
        "sql_point_top_k": top_k,
        "sql_top_k_agg": group,
        "sql_top_k_agg_direct": group,
        "sql_top_k_agg_groups": (
            f"WITH q AS (SELECT {p_main} AS p), s AS (SELECT label, CASE WHEN vec_id % 2 = 0 THEN 'even' END AS half, "
            f"'v' || vec_id AS name, {d_main} AS dist FROM embeddings, q), r AS (SELECT *, CAST(row_number() OVER ("
            "PARTITION BY label, half ORDER BY dist ASC NULLS LAST, name) AS INTEGER) AS rank FROM s) "
            f"SELECT label, half, rank, name, {_rnd('dist')} AS dist FROM r WHERE rank <= {GROUP_K}"),
        "fractal_search_column": (
            f"WITH {fam} SELECT e.vec_id, {_rnd(_dist('e.embedding::DOUBLE[]', 'fam.p'))} AS dist "
            f"FROM embeddings e JOIN fam ON fam.query_id = e.vec_id % {N_QUERIES}"),
        "fractal_search_consecutive": (
            f"SELECT a.vec_id, {_rnd(_dist('b.embedding::DOUBLE[]', 'a.embedding::DOUBLE[]'))} AS exact, "
            f"true AS matches, true AS within_residual FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"),
        "radius_many": (
            f"WITH {fam}, s AS (SELECT fam.query_id, e.vec_id, {_dist('e.embedding::DOUBLE[]', 'fam.p')} AS dist "
            f"FROM embeddings e, fam) SELECT query_id, vec_id, {_rnd('dist')} AS dist FROM s WHERE dist <= {RADIUS}"),
    }
    for name, o in WHOLE_OPTIONS.items():
        box = "true AS in_box, " if o.clip else ""
        out[name] = (f"SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim, {box}true AS fit_matches, "
                     "true AS improved FROM embeddings")
    li_vals = ", ".join(f"('{name}', {_lit(_refined(tuple(q)))})" for name, q in LINEITEM_QUERIES.items())
    out["lineitem_multi_top_k"] = (
        f"WITH fam(query_id, p) AS (VALUES {li_vals}), s AS (SELECT fam.query_id, {li_key}, {_dist(li_vec, 'fam.p')} "
        f"AS dist FROM lineitem, fam), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY "
        f"dist ASC NULLS LAST, {li_key}) AS INTEGER) AS rank FROM s) SELECT query_id, rank, {li_key}, "
        f"{_rnd('dist')} AS dist FROM r WHERE rank <= {K}")
    out["stream_multi_top_k"] = out["multi_query_top_k"]
    out["stream_radius"] = out["radius_search"]
    out["pivot_self_top_k"] = out["exact_self_top_k"]
    out["pivot_lineitem_top_k"] = (
        f"WITH f AS (SELECT {li_key}, {li_vec} AS v FROM lineitem), asked AS (SELECT l_suppkey AS query_id, v AS p "
        f"FROM f QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY {li_key}, v) = 1), "
        f"s AS (SELECT asked.query_id, {li_key}, {_dist('f.v', 'asked.p')} AS dist FROM f, asked), "
        f"r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY dist ASC NULLS LAST, {li_key}) "
        f"AS INTEGER) AS rank FROM s) SELECT query_id, rank, {li_key}, {_rnd('dist')} AS dist "
        f"FROM r WHERE rank <= {GROUP_K}")
    out.update(_llm()[1])
    return out
