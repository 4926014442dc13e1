"""Streaming scoring (S7) and the driver contract."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quiver import radius_many, search, search_many
from quiver.streaming.score import (current_top_k, run_stream_radius, run_stream_score, run_stream_top_k,
                                    vector_stream)

from conftest import SF001


def _write_parts(spark, folder, n_parts=3):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    for p in range(n_parts):
        emb.filter(F.pmod("vec_id", F.lit(n_parts)) == p).write.parquet(os.path.join(folder, f"part{p}"))
    return emb


def test_stream_score_matches_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    emb = _write_parts(spark, src)
    stream = vector_stream(spark, os.path.join(src, "*"), schema=emb.schema, max_files=1)
    _, path = run_stream_score(spark, stream, entry.main_query(), "vec_id",
                               out_path=os.path.join(tmp_dir, "out"),
                               checkpoint=os.path.join(tmp_dir, "ck"))
    got = {r["vec_id"]: r["dist"] for r in spark.read.parquet(path).collect()}
    assert len(got) == emb.count()
    top = search(emb, entry.main_query(), 5, id_col="vec_id").collect()
    assert all(abs(got[r["vec_id"]] - r["dist"]) < 1e-12 for r in top)


def test_stream_top_k_idempotent_merge(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    emb = _write_parts(spark, src)
    stream = vector_stream(spark, os.path.join(src, "*"), schema=emb.schema, max_files=1)
    _, path = run_stream_top_k(spark, stream, entry.main_query(), 10, "vec_id",
                               table_path=os.path.join(tmp_dir, "tk"),
                               checkpoint=os.path.join(tmp_dir, "ck"))
    got = [r["vec_id"] for r in current_top_k(spark, path, 10, "vec_id").collect()]
    want = [r["vec_id"] for r in search(emb, entry.main_query(), 10, id_col="vec_id").collect()]
    assert got == want
    versions = [r["batch_id"] for r in spark.read.parquet(path).select("batch_id").distinct().collect()]
    assert len(versions) == 2 and max(versions) == 2         # three batches, the last two kept


def test_unreadable_state_fails_the_batch(spark, tmp_dir):
    """A state that cannot be read is an error, never a fresh start."""
    import glob

    from pyspark.errors import StreamingQueryException

    src, tk, ck = (os.path.join(tmp_dir, x) for x in ("src", "tk", "ck"))
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    emb.filter("vec_id < 200").write.parquet(os.path.join(src, "a"))
    stream = lambda: vector_stream(spark, os.path.join(src, "*"), schema=emb.schema)
    run_stream_top_k(spark, stream(), entry.main_query(), 10, "vec_id", table_path=tk, checkpoint=ck)
    part = glob.glob(os.path.join(tk, "batch_id=0", "part-*.parquet"))[0]
    with open(part, "rb") as f:
        good = f.read()
    with open(part, "wb") as f:
        f.write(b"not parquet")
    os.remove(os.path.join(os.path.dirname(part), "." + os.path.basename(part) + ".crc"))
    emb.filter("vec_id >= 200").write.parquet(os.path.join(src, "b"))
    with pytest.raises(StreamingQueryException):
        run_stream_top_k(spark, stream(), entry.main_query(), 10, "vec_id", table_path=tk, checkpoint=ck)
    with open(part, "wb") as f:
        f.write(good)
    # a version without its commit marker is not there yet
    os.makedirs(os.path.join(tk, "batch_id=7"))
    run_stream_top_k(spark, stream(), entry.main_query(), 10, "vec_id", table_path=tk, checkpoint=ck)
    want = [r["vec_id"] for r in search(emb, entry.main_query(), 10, id_col="vec_id").collect()]
    assert [r["vec_id"] for r in current_top_k(spark, tk, 10, "vec_id").collect()] == want


def test_stream_keys_of_any_type_and_large_query_sets(spark, tmp_dir):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet").select(
        F.format_string("k%04d", "vec_id").alias("name"), "embedding")
    src = os.path.join(tmp_dir, "src")
    emb.repartition(2).write.parquet(src)
    queries = emb.filter("name < 'k0006'").select(F.col("name").alias("query_id"), F.col("embedding").alias("query"))
    want = sorted(search_many(emb, queries, 3, id_col="name").collect())
    for budget in (1 << 26, 1000):
        stream = vector_stream(spark, src, schema=emb.schema, max_files=1)
        _, path = run_stream_top_k(spark, stream, queries, 3, "name", broadcast_bytes=budget)
        assert sorted(current_top_k(spark, path, 3, "name", per_query=True).collect()) == want
    stream = vector_stream(spark, src, schema=emb.schema)
    _, path = run_stream_radius(spark, stream, queries, 0.6, "name", broadcast_bytes=1000)
    near = radius_many(emb, queries, 0.6, id_col="name")
    assert sorted(spark.read.parquet(path).collect()) == sorted(near.collect())


def test_entry_and_contract(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 10 and df.columns == ["vec_id", "dist"]
    qs, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(qs)
    no_oracle = {q for q in set(qs) - set(oracles) if not q.startswith("op") and q != "pipeline"}
    # its neighbours depend on points that SQL can not refine; self_top_k_check verifies each of them
    assert no_oracle == {"self_top_k"} and "self_top_k_check" in oracles


@pytest.mark.parametrize("name", ["top_k", "group_top_k", "min_distance_to_set", "lineitem_top_k", "lineitem_multi_top_k",
                                  "refine_search", "refine_local_walk", "refine_free_box", "fractal_search_column",
                                  "radius_many", "convergence_check"])
def test_registered_queries_match_duckdb(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("embeddings", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = entry.queries()[name](spark, SF001)
    cols = sorted(df.columns)
    mine = sorted(tuple(r[c] for c in cols) for r in df.collect())
    rel = con.sql(entry.oracle_sql()[name])
    theirs = sorted(tuple(r[rel.columns.index(c)] for c in cols) for r in rel.fetchall())
    assert mine == theirs


def test_a_column_of_distinct_queries_is_registered(spark):
    """Every embedding's successor is refined as a query of its own, and every row is scored."""
    test_registered_queries_match_duckdb(spark, "fractal_search_consecutive")
    n = spark.read.parquet(f"{SF001}/embeddings.parquet").count()
    assert entry.queries()["fractal_search_consecutive"](spark, SF001).count() == n - 1


def test_entry_runs_from_another_working_directory(tmp_dir):
    """Workers must import the package even when the driver starts elsewhere."""
    import subprocess
    import sys

    from conftest import ROOT

    code = ("import sys; sys.path.insert(0, %r)\n"
            "import __spark_entry__ as E\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "print('ROWS', len(E.entry(s).collect()))\n" % ROOT)
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, capture_output=True, text=True,
                         timeout=300)
    assert "ROWS 10" in out.stdout, out.stderr[-2000:]


def test_stream_restart_from_checkpoint_is_exactly_once(spark, tmp_dir):
    """A restarted stream picks up only new files; the sink holds every row once."""
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    src = os.path.join(tmp_dir, "src")
    out = os.path.join(tmp_dir, "out")
    ck = os.path.join(tmp_dir, "ck")
    tk, tkck = os.path.join(tmp_dir, "tk"), os.path.join(tmp_dir, "tkck")
    emb.filter("vec_id < 200").write.parquet(os.path.join(src, "a"))
    stream = lambda: vector_stream(spark, os.path.join(src, "*"), schema=emb.schema)
    run_stream_score(spark, stream(), entry.main_query(), "vec_id", out_path=out, checkpoint=ck)
    run_stream_top_k(spark, stream(), entry.main_query(), 10, "vec_id", table_path=tk, checkpoint=tkck)
    assert spark.read.parquet(out).count() == 200
    emb.filter("vec_id >= 200").write.parquet(os.path.join(src, "b"))
    run_stream_score(spark, stream(), entry.main_query(), "vec_id", out_path=out, checkpoint=ck)
    run_stream_top_k(spark, stream(), entry.main_query(), 10, "vec_id", table_path=tk, checkpoint=tkck)
    got = spark.read.parquet(out)
    assert got.count() == emb.count() and got.select("vec_id").distinct().count() == emb.count()
    want = [r["vec_id"] for r in search(emb, entry.main_query(), 10, id_col="vec_id").collect()]
    assert [r["vec_id"] for r in current_top_k(spark, tk, 10, "vec_id").collect()] == want


def test_bench_runs_from_another_working_directory(tmp_dir):
    """bench.py must print one JSON line wherever the driver starts it."""
    import json
    import subprocess
    import sys

    from conftest import ROOT

    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "top_k", "group_top_k"],
                         cwd=tmp_dir, capture_output=True, text=True, timeout=600, env=env)
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1, out.stderr[-2000:]
    res = json.loads(lines[0])
    assert set(res["queries"]) == {"top_k", "group_top_k"} and "errors" not in res
