"""Refinement: properties of the search and of the Spark job around it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quiver import RefineOptions, explore_queries, refine_queries, refine_with_ids, refinement_report
from quiver.operators.sfs import CosineObjective, query_seed, refine
from quiver.operators.checks import check_convergence


def _initial_best(q, opts):
    rng = np.random.Generator(np.random.SFC64(query_seed(q, opts.seed)))
    lo, hi = opts.box(len(q))
    X = lo + rng.random((opts.population, len(q))) * (hi - lo)
    return np.nanmin(CosineObjective(q[None, :])(X[None])[0])


@pytest.mark.parametrize("dim", [2, 3, 8, 64])
def test_never_worse_than_best_initial_particle_and_inside_box(dim):
    opts = RefineOptions()
    Q = np.random.default_rng(dim).normal(size=(5, dim))
    best, fit = refine(Q, opts)
    for j in range(5):
        assert fit[j] <= _initial_best(Q[j], opts) + 1e-15
        assert np.all(best[j] >= -1.0) and np.all(best[j] <= 1.0)
        assert abs(fit[j] - CosineObjective(Q[j:j + 1])(best[j:j + 1])[0]) < 1e-12


def test_convergence_low_dims():
    # F2: the reference's smoke check, |fractal_search(q, q)| <= 0.01 for q = [0.6, 0.8]
    best, fit = refine(np.array([[0.6, 0.8]]), RefineOptions())
    assert abs(fit[0]) <= 0.01
    Q = np.random.default_rng(7).normal(size=(20, 3))
    assert np.all(np.abs(refine(Q, RefineOptions())[1]) <= 0.01)


def test_same_query_same_bits_in_any_company():
    opts = RefineOptions(seed=11)
    Q = np.random.default_rng(0).normal(size=(6, 16))
    alone = refine(Q[2:3], opts)[0][0]
    together = refine(Q, opts)[0][2]
    assert np.array_equal(alone, together)
    other_seed = refine(Q[2:3], RefineOptions(seed=12))[0][0]
    assert not np.array_equal(alone, other_seed)


def test_degenerate_queries():
    opts = RefineOptions()
    zero = refine(np.zeros((1, 3)), opts)                  # N7: arbitrary but finite, repeatable
    assert np.all(np.isfinite(zero[0])) and zero[1][0] == 1.0
    assert np.array_equal(zero[0], refine(np.zeros((1, 3)), opts)[0])
    empty = refine(np.zeros((1, 0)), opts)                 # N8
    assert empty[0].shape == (1, 0) and empty[1][0] == 1.0
    nan = refine(np.array([[np.nan, 1.0]]), opts)          # N10: never improves
    assert np.isnan(nan[1][0]) and np.all(np.isfinite(nan[0]))
    # -0.0 and 0.0 seed the same stream
    assert query_seed(np.array([-0.0, 1.0]), 0) == query_seed(np.array([0.0, 1.0]), 0)


def test_walk_modes_and_box_options():
    q = np.array([[0.3, -0.2, 0.9]])
    local = refine(q, RefineOptions(walk=0.0))
    assert local[1][0] < 0.01
    boxed = refine(q, RefineOptions(lower=(0.0, -1.0, 0.0), upper=(1.0, 0.0, 1.0)))
    assert np.all(boxed[0] >= [0.0, -1.0, 0.0]) and np.all(boxed[0] <= [1.0, 0.0, 1.0])
    unclipped = refine(q, RefineOptions(clip=False, generations=3))
    assert np.all(np.isfinite(unclipped[0]))


def test_population_output():
    best, fit, X, fits = refine(np.array([[0.6, 0.8]]), RefineOptions(population=10), want_population=True)
    assert X.shape == (1, 10, 2) and fits.shape == (1, 10)
    assert fit[0] == fits[0].min()


def test_refine_job_partition_invariant(spark):
    rows = [(i, [float(np.sin(i + j)) for j in range(8)]) for i in range(40)]
    rows.append((40, rows[3][1]))                          # a duplicate query (R4)
    rows.append((41, None))                                # NULL query
    rows.append((42, [1.0, None]))                         # NULL element
    df = spark.createDataFrame(rows, "query_id long, query array<double>")
    a = {tuple(r["query"]): (tuple(r["best_point"]), r["best_fit"])
         for r in refine_queries(df, parallelism=1).collect() if r["query"] and None not in r["query"]}
    b = {tuple(r["query"]): (tuple(r["best_point"]), r["best_fit"])
         for r in refine_queries(df.repartition(7), parallelism=5).collect()
         if r["query"] and None not in r["query"]}
    assert a == b and len(a) == 40
    ids = {r["query_id"]: r for r in refine_with_ids(df, "query_id").collect()}
    assert len(ids) == 43
    assert ids[40]["best_point"] == ids[3]["best_point"]
    assert ids[41]["best_point"] is None and ids[42]["best_point"] is None
    local = refine(np.array([rows[5][1]]), RefineOptions())[0][0]
    assert np.array_equal(np.array(ids[5]["best_point"]), local)


def test_report_and_population_jobs(spark):
    df = spark.createDataFrame([([0.6, 0.8],), ([0.1, 0.9],)], "query array<double>")
    rep = refinement_report(df).collect()
    assert all(r["report"].startswith('{"best_point":[') for r in rep)
    pop = explore_queries(df, options=RefineOptions(population=7))
    assert pop.count() == 14
    assert pop.filter("is_best").groupBy("query").count().filter("count >= 1").count() == 2


def test_convergence_check_job(spark):
    df = spark.createDataFrame([([0.6, 0.8],)], "query array<double>")
    row = check_convergence(df).collect()[0]
    assert row["converged"] and row["status"] == "convergence ok"
    far = spark.createDataFrame([([float(np.sin(j)) for j in range(128)],)], "query array<double>")
    assert not check_convergence(far).collect()[0]["converged"]
    with pytest.raises(Exception, match="convergence failed"):
        check_convergence(far, raise_on_failure=True).collect()


def test_float_queries_refine_like_their_double_widening(spark):
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").filter("vec_id < 6")
    got = {r["vec_id"]: r["best_point"] for r in refine_with_ids(
        emb.select("vec_id", F.col("embedding").alias("query")), "vec_id").collect()}
    for r in emb.collect():
        want, _ = refine(np.asarray([r["embedding"]], dtype=np.float64), RefineOptions())
        assert np.array_equal(np.asarray(got[r["vec_id"]]), want[0])


def test_invalid_population_is_rejected():
    with pytest.raises(ValueError, match="population"):
        refine(np.array([[0.6, 0.8]]), RefineOptions(population=0))


def test_report_json_round_trips(spark):
    import json

    df = spark.createDataFrame([([0.6, 0.8],), ([0.3, -0.1, 0.5],)], "query array<double>")
    for r in refinement_report(df).collect():
        rep = json.loads(r["report"])
        assert rep["best_point"] == list(r["best_point"]) and rep["best_fit"] == r["best_fit"]


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_points_are_not_copied_for_queries_that_few_rows_repeat(spark, monkeypatch):
    from quiver.operators import refine as module

    rows = [(i, [float(np.sin(i % 7 + j)) for j in range(4)] if i % 5 else None) for i in range(60)]
    rows += [(100 + i, [1.0, -1.0, 0.5, 0.25]) for i in range(30)] + [(None, [1.0, -1.0, 0.5, 0.25]), (None, None)]
    options = RefineOptions(generations=2, population=4)
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"query_id long, query array<{kind}>")
        plain = refine_with_ids(df, "query_id", options=options)
        assert "Generate" not in _plan(plain) and plain.count() == len(rows)
        want = sorted(map(repr, refine_with_ids(df, "query_id", options=options, bounded=True).collect()))
        assert sorted(map(repr, plain.collect())) == want
        with monkeypatch.context() as m:
            m.setattr(module, "REPEATED", 20)
            dealt = refine_with_ids(df, "query_id", options=options)
            assert "Generate" in _plan(dealt) and sorted(map(repr, dealt.collect())) == want


def test_checked_neighbours_refine_their_own_points_once(spark, tmp_dir):
    import __spark_entry__ as entry

    rows = [(i, [float(np.sin(i * (j + 1))) for j in range(64)], i % 2) for i in range(12)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_dir}/embeddings.parquet")
    out = entry.queries()["self_top_k_check"](spark, tmp_dir)
    # one scoring function for each search; points are read from where they were written
    assert _plan(out).count("MapInArrow") == 2
    assert [tuple(r)[2:] for r in out.collect()] == [(True, True, True)] * 120


def test_a_query_column_moves_no_vector_twice(spark):
    from quiver import fractal_distance

    rows = [(i, [float(np.sin(i + j)) for j in range(4)], [float(np.cos(i % 3 + j)) for j in range(4)] if i % 4 else None)
            for i in range(20)]
    df = spark.createDataFrame(rows, "id long, embedding array<float>, q array<float>")
    out = fractal_distance(df, F.col("q"), options=RefineOptions(generations=2, population=4))
    assert out.columns == ["id", "embedding", "q", "dist"] and out.count() == 20
    plan = _plan(out)
    assert "Generate" not in plan and "__v" not in plan
    assert out.filter("dist IS NULL").count() == 5
