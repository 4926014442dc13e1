"""Search operators against brute force, edge cases N1-N14, plan and path invariance."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quiver import (cosine_distance, exact_search, fractal_distance, multi_probe_search, radius_many,
                    radius_search, search, search_groups, search_many, search_top_k,
                    valid_vector)
from quiver.functions.sql import fractal_search, register
from quiver.operators.checks import check_search_result, refinement_quality, single_query_quality
from quiver.operators.refine import refine_local
from quiver.operators.setdist import min_distance_to_set, refine_against_sets
from quiver.sources.io import random_vectors, smoke_rows, smoke_vectors

from conftest import SF001


def _cos(a, b):
    a, b = np.asarray(a, float), np.asarray(b, float)
    na, nb = a @ a, b @ b
    if na == 0 or nb == 0:
        return 1.0
    return 1.0 - (a @ b) / (math.sqrt(na) * math.sqrt(nb))


def _emb(spark):
    return spark.read.parquet(f"{SF001}/embeddings.parquet")


def _emb_np(spark):
    rows = _emb(spark).orderBy("vec_id").collect()
    return (np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float),
            np.array([r["label"] for r in rows]))


Q = [math.sin(j + 1.0) for j in range(64)]


def test_smoke_fixture_top3(spark):
    # F1: 32 rows of [sin(.1i), cos(.1i), sin(.2i)], query [0.5, 0.5, 0.0], top-3
    df = smoke_vectors(spark)
    top = search(df, [0.5, 0.5, 0.0], 3)
    chk = check_search_result(top, 3).collect()[0]
    assert chk["ok"] and chk["n"] == 3 and chk["n_null"] == 0 and chk["n_nonfinite"] == 0
    p, _ = refine_local([0.5, 0.5, 0.0])
    brute = sorted((_cos(v, p), i) for i, v in smoke_rows())[:3]
    assert [r["id"] for r in top.collect()] == [i for _, i in brute]


def test_top_k_matches_brute_force(spark):
    ids, E, _ = _emb_np(spark)
    p, _ = refine_local(Q)
    got = search(_emb(spark), Q, 10, id_col="vec_id").collect()
    d = np.array([_cos(e, p) for e in E])
    order = np.lexsort((ids, d))[:10]
    assert [r["vec_id"] for r in got] == ids[order].tolist()
    assert np.allclose([r["dist"] for r in got], d[order], atol=1e-12)
    ex = exact_search(_emb(spark), Q, 5, id_col="vec_id").collect()
    de = np.array([_cos(e, Q) for e in E])
    assert [r["vec_id"] for r in ex] == ids[np.lexsort((ids, de))[:5]].tolist()


def test_partition_layout_does_not_change_results(spark):
    emb = _emb(spark)
    a = search(emb.repartition(1), Q, 10, id_col="vec_id").collect()
    b = search(emb.repartition(7), Q, 10, id_col="vec_id").collect()
    assert a == b
    g1 = search_groups(emb.repartition(1), Q, "label", 3, id_col="vec_id").orderBy("label", "rank").collect()
    g2 = search_groups(emb.repartition(5), Q, "label", 3, id_col="vec_id").orderBy("label", "rank").collect()
    assert g1 == g2


def test_group_top_k_and_aggregate(spark):
    ids, E, labels = _emb_np(spark)
    p, _ = refine_local(Q)
    d = np.array([_cos(e, p) for e in E])
    got = search_groups(_emb(spark), Q, "label", 3, id_col="vec_id", salt_buckets=4)
    got = {(r["label"], r["rank"]): r["vec_id"] for r in got.collect()}
    for lab in np.unique(labels):
        sel = np.flatnonzero(labels == lab)
        order = sel[np.lexsort((ids[sel], d[sel]))][:3]
        assert [got[(lab, k + 1)] for k in range(3)] == ids[order].tolist()
    agg = search_top_k(_emb(spark), Q, 3, by="label", id_col="vec_id").collect()
    for r in agg:
        assert [x["vec_id"] for x in r["top_k"]] == [got[(r["label"], k + 1)] for k in range(3)]
    one = search_top_k(_emb(spark), Q, 4, id_col="vec_id").collect()[0]["top_k"]
    assert [x["vec_id"] for x in one] == [r["vec_id"] for r in
                                          search(_emb(spark), Q, 4, id_col="vec_id").collect()]


def test_radius_and_scalar_scores(spark):
    ids, E, _ = _emb_np(spark)
    p, _ = refine_local(Q)
    d = {int(i): _cos(e, p) for i, e in zip(ids, E)}
    rad = {r["vec_id"]: r["dist"] for r in radius_search(_emb(spark), Q, 0.9, id_col="vec_id").collect()}
    assert set(rad) == {i for i, v in d.items() if v <= 0.9}
    sc = {r["vec_id"]: r["dist"] for r in fractal_distance(_emb(spark), Q).collect()}
    assert all(abs(sc[i] - d[i]) < 1e-12 for i in d)


def test_many_queries_broadcast_and_block_paths_agree(spark):
    emb = _emb(spark)
    qs = emb.filter(F.col("vec_id") < 12).select(F.col("vec_id").alias("query_id"),
                                                 F.col("embedding").alias("query"))
    a = search_many(emb, qs, 5, id_col="vec_id").orderBy("query_id", "rank").collect()
    b = search_many(emb, qs, 5, id_col="vec_id", broadcast_bytes=1,
                    vector_broadcast_bytes=1).orderBy("query_id", "rank").collect()
    c = search_many(emb, qs, 5, id_col="vec_id", broadcast_bytes=1).orderBy("query_id", "rank").collect()
    assert a == b == c and len(a) == 60
    ids, E, _ = _emb_np(spark)
    p, _ = refine_local(E[3])
    d = np.array([_cos(e, p) for e in E])
    assert [r["vec_id"] for r in a if r["query_id"] == 3] == ids[np.lexsort((ids, d))[:5]].tolist()
    ex = search_many(emb, qs, 1, id_col="vec_id", exact=True).collect()
    assert all(r["vec_id"] == r["query_id"] for r in ex)   # a vector is its own nearest


EDGE = [
    (1, None), (2, [0.6, None]), (3, [0.6]), (4, [0.6, 0.8, 0.0]), (5, []),
    (6, [0.0, 0.0]), (7, [0.3, 0.4]), (8, [6.0, 8.0]), (9, [-0.6, -0.8]),
    (10, [float("nan"), 1.0]), (11, [0.8, 0.6]),
]


@pytest.fixture
def edge_df(spark):
    return spark.createDataFrame(EDGE, "id long, embedding array<double>")


def test_edge_cases_native_arrow_sql_agree(spark, edge_df):
    register(spark)
    q = [0.6, 0.8]
    arrow = {r["id"]: r["dist"] for r in fractal_distance(edge_df, q, exact=True).collect()}
    native = {r["id"]: r["d"] for r in edge_df.select("id", cosine_distance("embedding", F.array(
        F.lit(0.6), F.lit(0.8))).alias("d")).collect()}
    edge_df.createOrReplaceTempView("edge")
    sql = {r["id"]: r["d"] for r in spark.sql(
        "SELECT id, cosine_distance(embedding, array(0.6D, 0.8D)) AS d FROM edge").collect()}
    for res in (arrow, native, sql):
        assert res[1] is None and res[2] is None and res[3] is None and res[4] is None  # E1-E3
        assert res[5] is None
        assert res[6] == 1.0                                          # E5
        assert abs(res[7] - res[8]) < 1e-12                           # E6
        assert abs(res[9] - 2.0) < 0.01                               # E7
        assert math.isnan(res[10])                                    # E9
    valid = {r["id"]: r["v"] for r in edge_df.select("id", valid_vector("embedding", 2).alias("v")).collect()}
    assert [valid[i] for i in range(1, 12)] == [False, False, False, False, False] + [True] * 6


def test_null_and_nan_ordering(spark, edge_df):
    top = search(edge_df, [0.6, 0.8], 11, exact=True).collect()
    d = [r["dist"] for r in top]
    assert [r["id"] for r in top[-5:]] == [1, 2, 3, 4, 5]             # NULLs last, by id
    assert math.isnan(d[5]) and all(x is not None and not math.isnan(x) for x in d[:5])  # E9
    assert [r["id"] for r in search(edge_df, [0.6, 0.8], 3, exact=True).collect()][0] in (7, 8)


def test_null_query_and_empty_query(spark, edge_df):
    assert all(r["dist"] is None for r in fractal_distance(edge_df, None).collect())      # N4
    assert all(r["dist"] is None for r in fractal_distance(edge_df, [0.6, None]).collect())  # N5
    e = {r["id"]: r["dist"] for r in fractal_distance(edge_df, []).collect()}            # N8
    assert e[5] == 1.0 and all(v is None for k, v in e.items() if k != 5)
    z = fractal_distance(edge_df, [0.0, 0.0]).collect()                                  # N7
    assert all(r["dist"] is None or math.isfinite(r["dist"]) or r["id"] == 10 for r in z)
    zx = {r["id"]: r["dist"] for r in fractal_distance(edge_df, [0.0, 0.0], exact=True).collect()}
    assert zx[7] == 1.0 and zx[10] == 1.0          # the zero-norm rule comes before NaN
    top = search(edge_df, [0.0, 0.0], 7, exact=True).collect()
    assert [r["id"] for r in top] == [6, 7, 8, 9, 10, 11, 1] and top[-1]["dist"] is None


def test_per_row_query_column(spark):
    # Each row is scored against its own (refined) query
    df = spark.createDataFrame([(1, [0.6, 0.8], [0.6, 0.8]), (2, [0.6, 0.8], [0.8, -0.6]),
                                (3, [1.0, 0.0], None)], "id long, v array<double>, q array<double>")
    out = {r["id"]: r["d"] for r in df.select("id", fractal_search("v", "q").alias("d")).collect()}
    assert abs(out[1]) < 0.01 and abs(out[2] - 1.0) < 0.01 and out[3] is None


def test_sql_function_with_parameter(spark):
    register(spark)
    assert spark.catalog.functionExists("fractal_search")
    assert spark.catalog.functionExists("cosine_distance")
    _emb(spark).createOrReplaceTempView("emb_sql")
    got = spark.sql("SELECT vec_id, fractal_search(CAST(embedding AS ARRAY<DOUBLE>), :q) AS dist "
                    "FROM emb_sql ORDER BY dist ASC NULLS LAST, vec_id LIMIT 10", args={"q": Q}).collect()
    api = search(_emb(spark), Q, 10, id_col="vec_id").collect()
    assert [r["vec_id"] for r in got] == [r["vec_id"] for r in api]
    one = spark.sql("SELECT fractal_search(array(0.6D, 0.8D), array(0.6D, 0.8D)) AS d").collect()[0]["d"]
    assert abs(one) <= 0.01                                           # the reference's convergence check


def test_composite_key_and_feature_columns(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    q = [25.0, 30000.0, 0.05, 0.04]
    top = search(li, q, 5, vec=feats, id_col=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
                 exact=True).collect()
    rows = li.collect()
    best = sorted((_cos([r[c] for c in feats], q), r["l_orderkey"], r["l_linenumber"], r["l_partkey"],
                   r["l_suppkey"]) for r in rows)[:5]
    assert [(r["l_orderkey"], r["l_linenumber"], r["l_partkey"], r["l_suppkey"]) for r in top] == \
        [b[1:] for b in best]


def test_min_distance_to_set_paths_and_brute_force(spark):
    ids, E, labels = _emb_np(spark)
    emb = _emb(spark)
    members = emb.filter("label = 1")
    a = {r["vec_id"]: r["min_dist"] for r in min_distance_to_set(emb, members, id_col="vec_id").collect()}
    b = {r["vec_id"]: r["min_dist"] for r in
         min_distance_to_set(emb, members, id_col="vec_id", broadcast_bytes=1).collect()}
    S = E[labels == 1]
    for i, e in zip(ids[:50], E[:50]):
        want = min(1.0, min(_cos(e, s) for s in S))
        assert abs(a[i] - want) < 1e-12 and abs(b[i] - want) < 1e-12


def test_refine_against_sets(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.9, 0.1]), (1, [0.0, 1.0])],
                               "g int, embedding array<double>")
    out = {r["g"]: r for r in refine_against_sets(df, "g").collect()}
    assert out[0]["dim"] == 2 and out[0]["best_fit"] < 0.01 and out[1]["best_fit"] < 0.01
    small = {r["g"]: r for r in refine_against_sets(df, "g", broadcast_bytes=1).collect()}
    assert small == out


def test_refine_against_sets_keeps_every_length_and_group(spark):
    rows = [("a", [1.0, 0.0]), ("a", [0.8, 0.1]), ("a", [0.0, 1.0, 0.0]), ("b", None), ("b", [None, 1.0]),
            (None, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "g string, embedding array<double>").repartition(3)
    got = refine_against_sets(df, "g").collect()
    assert {(r.g, r.dim) for r in got} == {("a", 2), ("a", 3), ("b", None), (None, 2)}
    for r in got:
        if r.dim is None:
            assert r.best_point is None and r.best_fit is None
            continue
        members = [v for g, v in rows if g == r.g and v and None not in v and len(v) == r.dim]
        assert abs(r.best_fit - min(1.0, min(_cos(r.best_point, m) for m in members))) < 1e-9
        assert r.best_fit < 0.01 and all(-1 <= x <= 1 for x in r.best_point)


def test_multi_probe_and_quality(spark):
    emb = _emb(spark)
    mp = multi_probe_search(emb, Q, 5, probes=3, id_col="vec_id").collect()
    assert len(mp) == 5 and all(0 <= r["dist"] <= 2 for r in mp)
    qual = single_query_quality(emb, Q, 10, id_col="vec_id").collect()[0]
    assert 0 <= qual["recall"] <= 1
    qs = emb.filter("vec_id < 3").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    rq = refinement_quality(emb, qs, 5, id_col="vec_id").collect()
    assert len(rq) == 3 and all(r["hits"] >= 1 for r in rq)           # each finds itself


def test_generators(spark):
    a = random_vectors(spark, 100, 3, seed=5, partitions=4).collect()
    b = random_vectors(spark, 100, 3, seed=5, partitions=4).collect()
    assert a == b and len(a[0]["embedding"]) == 3
    assert all(0 <= x < 1 for r in a for x in r["embedding"])


def test_string_ids_use_key_ordering(spark, edge_df):
    df = edge_df.withColumn("id", F.format_string("r%02d", "id"))
    got = [r["id"] for r in search(df, [0.6, 0.8], 11, exact=True).collect()]
    ids = [r["id"] for r in search(edge_df, [0.6, 0.8], 11, exact=True).collect()]
    assert got == ["r%02d" % i for i in ids]
    rs = sorted(r["id"] for r in radius_search(df, [0.6, 0.8], 0.5, exact=True).collect())
    ri = sorted(r["id"] for r in radius_search(edge_df, [0.6, 0.8], 0.5, exact=True).collect())
    assert rs == ["r%02d" % i for i in ri] and len(ri) >= 3


def test_top_k_agg_orders_nan_and_null_last(spark, edge_df):
    arr = search_top_k(edge_df, [0.6, 0.8], 11, exact=True).collect()[0]["top_k"]
    flat = search(edge_df, [0.6, 0.8], 11, exact=True).collect()
    assert [x["id"] for x in arr] == [r["id"] for r in flat]


def test_io_helpers(spark, tmp_dir):
    from quiver.sources.io import create_table_as, vectors

    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    v = vectors(emb, "vec_id", "embedding")
    assert dict(v.dtypes)["embedding"] == "array<double>"
    t = create_table_as(v.filter("label = 2"), "quiver_ctas_test")
    assert spark.table("quiver_ctas_test").count() == t.count() == emb.filter("label = 2").count()
    path = f"{tmp_dir}/parts"
    emb.repartition(3).write.parquet(path)
    assert spark.read.parquet(f"{path}/*.parquet").count() == emb.count()


def test_sql_vector_valid_and_string_ids(spark, edge_df):
    register(spark)
    edge_df.createOrReplaceTempView("edge_v")
    v = {r["id"]: r["v"] for r in spark.sql("SELECT id, vector_valid(embedding, 2) AS v FROM edge_v").collect()}
    assert v[1] is None or v[1] is False
    assert [bool(v[i]) for i in range(2, 12)] == [False, False, False, False] + [True] * 6
    sdf = edge_df.withColumn("id", F.col("id").cast("string"))
    found = search_many(sdf, spark.createDataFrame([(0, [0.6, 0.8])], "query_id long, query array<double>"), 2,
                        exact=True)
    assert found.dtypes[2] == ("id", "string") and [r["rank"] for r in found.collect()] == [1, 2]


def test_feature_columns_with_integer_ids(spark):
    rows = smoke_rows()
    df = spark.createDataFrame([(i, v[0], v[1], v[2]) for i, v in rows], "id long, a double, b double, c double")
    q = [0.5, 0.5, 0.0]
    got = [r["id"] for r in search(df, q, 4, vec=["a", "b", "c"], exact=True).collect()]
    assert got == [i for _, i in sorted((_cos(v, q), i) for i, v in rows)[:4]]
    grp = search_groups(df.withColumn("g", F.col("id") % 2), q, "g", 2, vec=["a", "b", "c"], exact=True)
    assert grp.count() == 4


def test_sql_fractal_refine_matches_jobs(spark):
    register(spark)
    row = spark.sql("SELECT fractal_refine(array(0.6D, 0.8D)) AS p, fractal_refine(CAST(NULL AS ARRAY<DOUBLE>)) AS n, "
                    "cosine_distance(array(0.6D, 0.8D), fractal_refine(array(0.6D, 0.8D))) AS r").collect()[0]
    p, _ = refine_local([0.6, 0.8])
    assert np.array_equal(np.array(row["p"]), p) and row["n"] is None and abs(row["r"]) <= 0.01


@pytest.mark.parametrize("k", [0, -1, 2.5])
def test_bad_k_is_rejected(spark, edge_df, k):
    with pytest.raises(ValueError, match="k must be"):
        search(edge_df, [0.6, 0.8], k)


@pytest.mark.parametrize("budget", [1 << 26, 3000, 1])
def test_size_limits_change_no_result(spark, budget):
    """Several broadcasts give the rows, columns and types that one gives."""
    rows = [(f"r{i % 37:02d}", i, [float(x) for x in np.random.default_rng(i % 50).normal(size=3)]) for i in range(60)]
    rows += [("null", 100, None), ("hole", 101, [1.0, None, 0.0]), ("short", 102, [1.0, 2.0]),
             ("short", 103, [2.0, 1.0]), ("zero", 104, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "`row id` string, n int, `v.x` array<double>").repartition(4)
    df = df.withColumn("query_id", F.lit("clash")).withColumn("__d", F.lit(1))
    members = spark.createDataFrame([([1.0, 0.5],)] + [(None,)] * 50 + [([0.3, 0.2, 0.1],)] * 9 + [([0.0, 0.0, 0.0],)],
                                    "m array<double>")
    near = min_distance_to_set(df, members, "v.x", "m", ["row id", "n"], broadcast_bytes=budget,
                               passthrough=["query_id"])
    assert near.dtypes == [("row id", "string"), ("n", "int"), ("query_id", "string"), ("min_dist", "double")]
    near = sorted(near.collect(), key=lambda r: r.n)
    assert len(near) == 65
    for (_, n, v), r in zip(sorted(rows, key=lambda x: x[1]), near):
        same = [m for m in ([1.0, 0.5], [0.3, 0.2, 0.1], [0.0] * 3) if v and None not in v and len(m) == len(v)]
        want = min([1.0] + [_cos(v, m) for m in same]) if same else None
        assert (r.min_dist is None) == (want is None) and (want is None or abs(r.min_dist - want) < 1e-12)
    none = min_distance_to_set(df, members.filter("m IS NULL"), "v.x", "m", "n", broadcast_bytes=budget).collect()
    assert {r.min_dist for r in none if r.n not in (100, 101)} == {1.0}
    assert {r.min_dist for r in none if r.n in (100, 101)} == {None}

    queries = df.select(F.col("row id"), F.col("`v.x`").alias("query"), F.col("n").alias("q n")).filter("n % 3 = 0")
    found = search_many(df, queries, 4, "v.x", ["row id", "n"], ["row id", "q n"], exact=True,
                        broadcast_bytes=budget, vector_broadcast_bytes=1)
    assert found.dtypes == [("query_row id", "string"), ("q n", "int"), ("rank", "int"), ("row id", "string"),
                            ("n", "int"), ("dist", "double")]
    found = sorted(found.collect(), key=lambda r: (r["q n"], r["rank"]))
    vectors = search_many(df, queries, 4, "v.x", ["row id", "n"], ["row id", "q n"], exact=True,
                          broadcast_bytes=1, vector_broadcast_bytes=1 << 26).collect()
    assert sorted(vectors, key=lambda r: (r["q n"], r["rank"])) == found
    by_n = {n: v for _, n, v in rows}
    for n, q in by_n.items():
        if n % 3 == 0:
            scored = sorted(((d is None, d or 0.0, i, m) for i, m, v in rows
                             for d in [_cos(q, v) if q and v and None not in q and None not in v
                                       and len(q) == len(v) else None]))[:4]
            assert [r["n"] for r in found if r["q n"] == n] == [s[3] for s in scored]

    close = radius_many(df, queries, 0.2, "v.x", ["row id", "n"], ["row id", "q n"], exact=True,
                        broadcast_bytes=budget)
    want = {(a, b) for a, q in by_n.items() if a % 3 == 0 for b, v in by_n.items()
            if q and v and None not in q and None not in v and len(q) == len(v) and _cos(q, v) <= 0.2}
    assert {(r["q n"], r["n"]) for r in close.collect()} == want


def test_overflowing_rows_do_not_hide_winners(spark):
    rows = [(i, [1e308, 1e308]) for i in range(4)] + [(10 + i, [-1.0, 0.1 * i]) for i in range(6)]
    rows += [(20, [1e-200, 2e-200])]
    df = spark.createDataFrame(rows, "id long, embedding array<double>").coalesce(1)
    got = [r["id"] for r in search(df, [1.0, 1.0], 3, exact=True).collect()]
    score = {i: _cos([1.0, 1.0], v) for i, v in rows}
    want = sorted(score, key=lambda i: (math.isnan(score[i]), 0 if math.isnan(score[i]) else score[i], i))[:3]
    assert got == want and not any(math.isnan(score[i]) for i in got)


def test_names_and_types_survive(spark, edge_df):
    df = edge_df.select(F.col("id").cast("int").alias("query_id"), "embedding", F.array(F.col("id") % 2).alias("g"))
    out = search(df, [0.6, 0.8], 3, id_col="query_id", exact=True)
    assert out.dtypes == [("query_id", "int"), ("dist", "double")]
    by = search_groups(df, [0.6, 0.8], "query_id", 2, id_col="query_id", exact=True)
    assert by.count() == df.count()
    nested = search_groups(df, [0.6, 0.8], "g", 2, id_col="query_id", exact=True).collect()
    assert {(tuple(r["g"]), r["rank"]) for r in nested} == {((g,), k) for g in (0, 1) for k in (1, 2)}


def test_distance_to_a_query_column(spark):
    from quiver.operators import refine as refine_module

    emb = _emb(spark).filter("vec_id < 60")
    q = F.when(F.col("vec_id") % 7 == 0, F.lit(None)).otherwise(
        F.array(*[F.col("vec_id") % 3 + F.lit(float(j % 5)) for j in range(64)]))
    got = {r["vec_id"]: r["dist"] for r in fractal_distance(emb, q).collect()}
    udf = {r["vec_id"]: r["d"] for r in emb.select("vec_id", fractal_search(
        F.col("embedding").cast("array<double>"), q.cast("array<double>")).alias("d")).collect()}
    assert got == udf and sum(d is None for d in got.values()) == 9
    refined = refine_module.refine_queries(emb.select(q.alias("query")))
    assert refined.filter("best_point IS NOT NULL").count() == 3


def test_arrow_and_catalyst_distances_are_bit_identical(spark):
    emb = _emb(spark)
    q = [float(x) for x in np.round(np.sin(np.arange(64) * 0.37), 6)]
    arrow = {r["vec_id"]: r["dist"] for r in fractal_distance(emb, q, exact=True).collect()}
    native = {r["vec_id"]: r["d"] for r in emb.select(
        "vec_id", cosine_distance("embedding", F.array(*[F.lit(x) for x in q])).alias("d")).collect()}
    assert arrow == native
    top = {r["vec_id"]: r["dist"] for r in exact_search(emb, q, 25, id_col="vec_id").collect()}
    assert all(native[i] == d for i, d in top.items())


def test_with_payload(spark):
    from quiver import with_payload

    emb = _emb(spark)
    emb.createOrReplaceTempView("emb_payload")
    top = search(spark.table("emb_payload"), Q, 5, id_col="vec_id")
    wide = with_payload(top, emb, "vec_id", ["label"]).collect()
    labels = {r["vec_id"]: r["label"] for r in emb.collect()}
    assert len(wide) == 5 and all(r["label"] == labels[r["vec_id"]] for r in wide)


def _seq_cos(E, p):
    """The scalar formula, summed left to right, vectorised over rows."""
    dot = np.zeros(len(E))
    na = np.zeros(len(E))
    nb = 0.0
    for j in range(E.shape[1]):
        dot = dot + E[:, j] * p[j]
        na = na + E[:, j] * E[:, j]
        nb = nb + p[j] * p[j]
    out = 1.0 - dot / (np.sqrt(na) * math.sqrt(nb))
    return np.where((na == 0) | (nb == 0), 1.0, out)


def _brute_top(ids, E, q, k):
    p, _ = refine_local(q)
    d = _seq_cos(E, p)
    order = np.lexsort((ids, d))[:k]
    return ids[order].tolist(), d[order]


def test_reference_samples_f3_f4(spark):
    register(spark)
    # the load script's basic call, a vector scored against itself
    f3 = spark.sql("SELECT fractal_search(array(0.6D, 0.8D, 0.0D), array(0.6D, 0.8D, 0.0D)) AS d").collect()
    assert abs(f3[0]["d"]) <= 0.01
    # 999 rows of three uniform randoms (ids 1..999), query [0.5, 0.5, 0.5], top-10
    df = random_vectors(spark, 999, 3, seed=4, start=1, partitions=3)
    rows = df.collect()
    ids = np.array([r["id"] for r in rows])
    E = np.array([r["embedding"] for r in rows])
    want, _ = _brute_top(ids, E, [0.5, 0.5, 0.5], 10)
    assert [r["id"] for r in search(df, [0.5, 0.5, 0.5], 10).collect()] == want


def test_reference_sample_f5_million_rows(spark):
    # 1,000,000 rows of three uniform randoms (ids 0..999,999), top-10
    df = random_vectors(spark, 1_000_000, 3, seed=5, partitions=8)
    top = search(df, [0.5, 0.5, 0.5], 10).collect()
    arr = df.toArrow()
    ids = arr.column("id").to_numpy()
    E = np.asarray(arr.column("embedding").combine_chunks().flatten().to_numpy()).reshape(-1, 3)
    want, d = _brute_top(ids, E, [0.5, 0.5, 0.5], 10)
    assert [r["id"] for r in top] == want
    assert [r["dist"] for r in top] == d.tolist()                # bit for bit


def test_group_top_k_string_groups_with_null(spark):
    emb = _emb(spark).withColumn(
        "grp", F.when(F.col("label") < 3, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("g"), (F.col("label") % 2).cast("string"))))
    out = search_groups(emb, Q, "grp", 3, id_col="vec_id", exact=True).collect()
    groups = {}
    for r in sorted(out, key=lambda r: ((r["grp"] or ""), r["rank"])):
        groups.setdefault(r["grp"], []).append(r["vec_id"])
    assert set(groups) == {None, "g0", "g1"} and all(len(v) == 3 for v in groups.values())
    ids, E, labels = _emb_np(spark)
    d = np.array([_cos(e, Q) for e in E])
    sel = np.flatnonzero(labels < 3)
    assert groups[None] == ids[sel][np.lexsort((ids[sel], d[sel]))][:3].tolist()


def test_group_top_k_any_key_type(spark):
    emb = _emb(spark)
    by_int = search_groups(emb, Q, "label", 3, id_col="vec_id", exact=True).collect()
    s_emb = emb.withColumn("key", F.format_string("k%04d", "vec_id"))
    by_str = search_groups(s_emb, Q, "label", 3, id_col="key", exact=True).collect()
    assert sorted((r["label"], r["rank"], "k%04d" % r["vec_id"], r["dist"]) for r in by_int) == \
        sorted((r["label"], r["rank"], r["key"], r["dist"]) for r in by_str)
    two = search_groups(emb.withColumn("part", F.lit(7)), Q, "label", 3,
                        id_col=["part", "vec_id"], exact=True).collect()
    assert sorted((r["label"], r["rank"], r["vec_id"]) for r in two) == \
        sorted((r["label"], r["rank"], r["vec_id"]) for r in by_int)
    agg = search_top_k(s_emb, Q, 2, by="label", id_col="key", exact=True).collect()
    assert all(len(r["top_k"]) == 2 and r["top_k"][0]["key"].startswith("k") for r in agg)


def test_empty_inputs(spark):
    emb = _emb(spark)
    none_q = spark.createDataFrame([], "query_id long, query array<double>")
    assert search_many(emb, none_q, 3, id_col="vec_id").count() == 0
    empty = emb.filter("vec_id < 0")
    qs = emb.filter("vec_id < 3").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    assert search_many(empty, qs, 3, id_col="vec_id").count() == 0
    assert search(empty, Q, 5, id_col="vec_id").count() == 0
    assert search_groups(empty, Q, "label", 5, id_col="vec_id").count() == 0
    assert radius_search(empty, Q, 0.5, id_col="vec_id").count() == 0
    assert min_distance_to_set(emb, empty, id_col="vec_id").filter("min_dist = 1.0").count() == emb.count()


def test_multi_probe_any_key_type(spark):
    emb = _emb(spark)
    a = multi_probe_search(emb, Q, 6, probes=4, id_col="vec_id").collect()
    s_emb = emb.withColumn("key", F.format_string("k%04d", "vec_id"))
    b = multi_probe_search(s_emb, Q, 6, probes=4, id_col="key").collect()
    assert [("k%04d" % r["vec_id"], r["dist"]) for r in a] == [(r["key"], r["dist"]) for r in b]


def test_result_check_raises_on_bad_results(spark, edge_df):
    short = search(edge_df, [0.6, 0.8], 3, exact=True)
    row = check_search_result(short, 5).collect()[0]
    assert not row["ok"] and row["status"] == "expected 5 top-k rows, got 3"
    with pytest.raises(Exception, match="expected 5 top-k rows"):
        check_search_result(short, 5, raise_on_failure=True).collect()
    with_null = search(edge_df, [0.6, 0.8], 11, exact=True)           # NULL and NaN rows included
    row = check_search_result(with_null, 11).collect()[0]
    assert row["n_null"] == 5 and row["n_nonfinite"] == 1 and not row["ok"]
