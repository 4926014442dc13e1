"""The pivot join against search_many: same rows, odd vectors, ties, and how much it skips."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from quiver import pivot_search_many, pivot_search_report, search_many
from quiver.operators import pivots

from conftest import SF001


def _rows(df):
    return sorted(((r["query_id"], r["rank"], r["id"], r["dist"]) for r in df.collect()), key=repr)


def _frame(spark, vectors, id_type=LongType(), name="id", vector="embedding"):
    schema = StructType([StructField(name, id_type), StructField(vector, ArrayType(DoubleType()))])
    return spark.createDataFrame([(i, v) for i, v in vectors], schema)


def _clusters(rng, n, dim, centres, spread):
    c = rng.normal(size=(centres, dim))
    return (c[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, dim))).tolist()


def _both(spark, vectors, queries, k, **kw):
    emb = _frame(spark, vectors, kw.pop("id_type", LongType()))
    asked = _frame(spark, queries, name="query_id", vector="query")
    # no scan: the rounds themselves are tested
    return (_rows(pivot_search_many(emb, asked, k, exact=True, scan_share=1.0)),
            _rows(search_many(emb, asked, k, exact=True)))


def test_same_rows_as_search_many_on_the_given_table(spark):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet").withColumnRenamed("vec_id", "id")
    asked = emb.select(F.col("id").alias("query_id"), F.col("embedding").alias("query"))
    assert _rows(pivot_search_many(emb, asked, 5, exact=True)) == _rows(search_many(emb, asked, 5, exact=True))


def test_refined_queries(spark):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet").withColumnRenamed("vec_id", "id")
    asked = emb.filter("id < 12").select(F.col("id").alias("query_id"), F.col("embedding").alias("query"))
    assert _rows(pivot_search_many(emb, asked, 4)) == _rows(search_many(emb, asked, 4))


def test_odd_vectors_and_ties(spark):
    rng = np.random.default_rng(3)
    vectors = _clusters(rng, 150, 4, 6, 0.05)
    vectors += [vectors[0]] * 60 + [[0.0] * 4] * 30                     # copies and zero rows, more than k
    vectors += [None, [], [1.0], [1.0, 2.0], [None, 1.0, 2.0, 3.0], [float("nan")] * 4, [float("inf"), 1.0, 0.0, 0.0],
                [1e200, 1e200, 0.0, 0.0], [1e-200, 0.0, 0.0, 0.0], [-1.0, -2.0, -3.0, -4.0], [3.0, 1.0], [2.0, 2.0]]
    rows = list(enumerate(vectors))
    queries = rows + [(1000 + i, v) for i, v in rows[::7]] + [(7, vectors[3])]
    for k in (3, 12):
        got, want = _both(spark, rows, queries, k)
        assert repr(got) == repr(want)


def test_opposite_rows_when_few_are_near(spark):
    # fewer near rows than k, so zero rows (distance 1) and far ones fill up
    rows = list(enumerate([[1.0, 0.0], [1.0, 0.1], [-1.0, 0.0], [-1.0, 0.2], [0.0, 0.0], [0.0, 0.0], [0.0, 1.0]]))
    got, want = _both(spark, rows, rows, 5)
    assert got == want


def test_string_and_null_keys(spark):
    rng = np.random.default_rng(5)
    vectors = _clusters(rng, 60, 3, 4, 0.1)
    rows = [(None if i == 5 else f"r{i % 50}", v) for i, v in enumerate(vectors)]
    got, want = _both(spark, rows, list(enumerate(vectors)), 4, id_type=StringType())
    assert got == want


def test_small_blocks_and_parts_change_nothing(spark, monkeypatch):
    # a hot cell: most rows are copies of one vector
    rng = np.random.default_rng(9)
    hot = rng.normal(size=5).tolist()
    rows = list(enumerate([hot] * 200 + _clusters(rng, 100, 5, 5, 0.3)))
    monkeypatch.setattr(pivots, "BLOCKS_PER_PART", 1)
    got, want = _both(spark, rows, rows[::3], 6)
    assert got == want


def test_empty_tables(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0])]
    assert _both(spark, [], rows, 2) == ([], [])
    assert _both(spark, rows, [], 2) == ([], [])


def test_names_of_the_callers_own(spark):
    rows = list(enumerate(np.random.default_rng(1).normal(size=(40, 3)).tolist()))
    emb = _frame(spark, rows, name="row`id", vector="v.x").withColumn("__lo", F.lit(1))
    asked = _frame(spark, rows, name="row`id", vector="q")
    args = dict(vec="v.x", id_col="row`id", query_id_col="row`id", query_col="q", exact=True)
    got, want = pivot_search_many(emb, asked, 3, **args), search_many(emb, asked, 3, **args)
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())


def test_k_must_be_positive(spark):
    emb = _frame(spark, [(0, [1.0])])
    with pytest.raises(ValueError):
        pivot_search_many(emb, emb, 0, query_id_col="id", query_col="embedding")


def test_clusters_are_skipped_and_noise_loses_nothing(spark):
    rng = np.random.default_rng(11)
    for vectors, least in ((_clusters(rng, 1200, 16, 25, 0.02), 0.8), (rng.normal(size=(300, 16)).tolist(), 0.0)):
        rows = list(enumerate(vectors))
        emb, asked = _frame(spark, rows), _frame(spark, rows, name="query_id", vector="query")
        told = pivot_search_report(emb, asked, 5, exact=True).first()
        assert told["pairs"] == len(rows) ** 2 and told["queries"] == told["rows"] == len(rows)
        assert least <= told["skipped"] <= 1.0 and told["pairs_met"] <= told["pairs"]
        assert _rows(pivot_search_many(emb, asked, 5, exact=True)) == _rows(search_many(emb, asked, 5, exact=True))


def test_scan_and_rounds_agree(spark):
    rows = list(enumerate(np.random.default_rng(4).normal(size=(200, 12)).tolist()))
    emb, asked = _frame(spark, rows), _frame(spark, rows, name="query_id", vector="query")
    found = [_rows(pivot_search_many(emb, asked, 3, exact=True, scan_share=x)) for x in (0.0, 1.0)]
    assert found[0] == found[1] == _rows(search_many(emb, asked, 3, exact=True))
    assert pivot_search_report(emb, asked, 3, exact=True, scan_share=0.0).first()["skipped"] == 0.0


def test_bounds_hold_for_fitted_cells():
    rng = np.random.default_rng(2)
    mat = rng.normal(size=(400, 8))
    units = mat / np.linalg.norm(mat, axis=1, keepdims=True)
    fitted = pivots.fit_pivots(units, 20)
    assert fitted.shape == (20, 8) and np.allclose(np.linalg.norm(fitted, axis=1), 1.0)
    to_pivot = pivots._angles(units, fitted)
    between = np.arccos(np.clip(units @ units.T, -1.0, 1.0))
    for c in range(20):
        assert (np.abs(to_pivot[:, c][:, None] - to_pivot[:, c][None, :]) <= between + pivots.angle_margin(8)).all()
