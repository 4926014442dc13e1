"""SQL table functions, the kept point table, searches against large sets, task counts."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quiver import (PointTable, RefineOptions, explore_queries, refine_against_sets, refine_queries, register_tables,
                    search_top_k)
from quiver.operators.refine import distinct_queries, refine_local
from quiver.plans.session import default_parallelism

Q = [0.3, -0.5, 0.8]


def rows(n=400, seed=1):
    rng = np.random.default_rng(seed)
    out = [(i, int(i % 7 != 0), [None, "a", "b"][i % 3], rng.normal(size=3).tolist()) for i in range(n)]
    out += [(n, 5, "a", None), (n + 1, 5, "a", [1.0, None, 2.0]), (n + 2, 5, "a", [0.0, 0.0, 0.0]), (n + 3, 5, "b", [1.0]),
            (n + 4, None, "b", [float("nan"), 1.0, 0.0]), (n + 5, None, "b", out[0][3]), (n + 6, 1, "b", out[1][3])]
    return out


@pytest.fixture
def table(spark):
    df = spark.createDataFrame(rows(), "vec_id long, label int, half string, embedding array<double>").repartition(6)
    df.createOrReplaceTempView("vectors_of_tables_test")
    spark.sql("DECLARE OR REPLACE VARIABLE p ARRAY<DOUBLE>")
    return df


def plain(found):
    return sorted(((*r[:-1], [(i["vec_id"], repr(i["dist"])) for i in r[-1]]) for r in map(tuple, found.collect())), key=repr)


@pytest.mark.parametrize("k", [1, 4, 1000])
def test_two_step_top_k_equals_the_python_form(spark, table, k):
    register_tables(spark)
    spark.sql("SET VARIABLE p = (SELECT best_point FROM fractal_points(TABLE(SELECT CAST(:q AS ARRAY<DOUBLE>) AS query)))",
              args={"q": Q})
    want = plain(search_top_k(table, Q, k, by="label", id_col="vec_id"))
    two = spark.sql(f"SELECT label, nearest_top_k(top_k, {k}) AS top_k FROM nearest_parts(TABLE("
                    f"SELECT label, vec_id, embedding FROM vectors_of_tables_test), p, {k}) GROUP BY label")
    assert plain(two) == want
    one = spark.sql(f"SELECT label, fractal_search_top_k(embedding, vec_id, :q, {k}) AS top_k "
                    "FROM vectors_of_tables_test GROUP BY label", args={"q": Q})
    assert plain(one) == want
    # the first step runs where the rows are and hands on k rows a task and group at most
    parts = spark.sql(f"SELECT spark_partition_id() AS t, * FROM nearest_parts(TABLE(SELECT label, vec_id, embedding "
                      f"FROM vectors_of_tables_test), p, {k})")
    got = parts.collect()
    assert all(len(r.top_k) <= k for r in got)
    assert len(got) <= 6 * 4 and len({(r.t, r.label) for r in got}) == len(got)
    plan = two._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("ArrowEvalPythonUDTF")[:2]
    assert "hashpartitioning(label" in above and "hashpartitioning(label" not in below.split("Initial Plan")[0]


def test_top_k_of_several_groups_and_any_id(spark, table):
    register_tables(spark, groups="label int, half string", id_ddl="name string")
    spark.sql("SET VARIABLE p = CAST(:q AS ARRAY<DOUBLE>)", args={"q": Q})
    named = table.withColumn("name", F.concat(F.lit("é"), F.col("vec_id")))
    named.createOrReplaceTempView("vectors_of_tables_test")
    got = {(r.label, r.half): [i.name for i in r.top_k] for r in spark.sql(
        "SELECT label, half, nearest_top_k(top_k, 3) AS top_k FROM nearest_parts(TABLE(SELECT label, half, name, embedding "
        "FROM vectors_of_tables_test), p, 3) GROUP BY label, half").collect()}
    want = {(r.label, r.half): [i.name for i in r.top_k] for r in named.groupBy("label", "half").agg(
        F.expr("1")).select("label", "half").join(
            search_top_k(named.withColumn("g", F.struct("label", "half")), Q, 3, by="g", id_col="name", exact=True)
            .select(F.col("g.label").alias("l"), F.col("g.half").alias("h"), "top_k"),
            F.col("label").eqNullSafe(F.col("l")) & F.col("half").eqNullSafe(F.col("h"))).collect()}
    assert got == want and len(got) > 6
    register_tables(spark, groups="", id_ddl="d decimal(12,2)")
    whole = spark.sql("SELECT nearest_top_k(top_k, 5) AS top_k FROM nearest_parts(TABLE(SELECT CAST(vec_id AS "
                      "DECIMAL(12,2)), embedding FROM vectors_of_tables_test), p, 5)").first().top_k
    assert [int(i.d) for i in whole] == [i.vec_id for i in search_top_k(table, Q, 5, id_col="vec_id", exact=True).first().top_k]
    with pytest.raises(ValueError):
        register_tables(spark, id_ddl="a int, b int")


def test_top_k_of_an_empty_table(spark, table):
    register_tables(spark)
    spark.sql("SET VARIABLE p = CAST(:q AS ARRAY<DOUBLE>)", args={"q": Q})
    assert spark.sql("SELECT * FROM nearest_parts(TABLE(SELECT label, vec_id, embedding FROM vectors_of_tables_test "
                     "WHERE vec_id < 0), p, 5)").count() == 0


def test_points_once_per_distinct_query(spark, table):
    register_tables(spark)
    many = table.select(F.element_at(F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)), F.pmod("vec_id", F.lit(3)).cast("int") + 1)
                        .alias("x")).select(F.array("x", F.lit(-1.0)).alias("query"))
    many.createOrReplaceTempView("queries_of_tables_test")
    got = spark.sql("SELECT * FROM fractal_points(TABLE(SELECT DISTINCT query FROM queries_of_tables_test))").collect()
    assert sorted(r.query for r in got) == [[1.0, -1.0], [2.0, -1.0], [3.0, -1.0]]
    for r in got:
        point, fit = refine_local(r.query)
        assert r.best_point == point.tolist() and r.best_fit == fit
    odd = spark.createDataFrame([([0.0, 0.0],), (None,), ([1.0, None],), ([],)], "query array<double>")
    odd.createOrReplaceTempView("queries_of_tables_test")
    got = {repr(r.query): r.best_point for r in spark.sql(
        "SELECT * FROM fractal_points(TABLE(SELECT query FROM queries_of_tables_test))").collect()}
    assert got["None"] is None and got["[1.0, None]"] is None and got["[]"] == [] and len(got["[0.0, 0.0]"]) == 2


def test_population_as_a_table(spark, table):
    register_tables(spark, RefineOptions(generations=3, population=6))
    queries = table.filter("vec_id < 5").select(F.col("embedding").alias("query"))
    queries.createOrReplaceTempView("queries_of_tables_test")
    want = sorted(map(tuple, explore_queries(queries, options=RefineOptions(generations=3, population=6)).collect()))
    whole = spark.sql("SELECT * FROM fractal_population(TABLE(SELECT query FROM queries_of_tables_test))")
    assert sorted(map(tuple, whole.collect())) == want and len(want) == 30
    each = spark.sql("SELECT query, x.* FROM queries_of_tables_test, LATERAL fractal_explore(query) x")
    assert sorted(map(tuple, each.collect())) == want
    none = spark.sql("SELECT x.* FROM (SELECT CAST(NULL AS ARRAY<DOUBLE>) AS query), LATERAL fractal_explore(query) x")
    assert none.count() == 0


def test_point_table_refines_new_queries_only(spark, table, tmp_dir):
    queries = table.select(F.col("embedding").alias("query"))
    whole = rows()
    kept = PointTable(spark, tmp_dir)
    assert kept.known().count() == 0 and kept.parts() == []
    kept.refine(queries.filter(F.col("query").isNotNull()).limit(0))
    assert kept.parts() == []
    kept.refine(table.filter("vec_id < 390").select(F.col("embedding").alias("query")))
    assert spark.read.parquet(*kept.parts()).count() == 390
    points = kept.refine(queries)
    added = spark.read.parquet(kept.parts()[0]).count(), spark.read.parquet(kept.parts()[1]).count()
    # 10 more, and zero, short and NaN vectors; copies and NULLs add none
    assert sorted(added) == [13, 390] and len(kept.parts()) == 2
    assert sorted(map(repr, points.collect())) == sorted(map(repr, refine_queries(queries).collect()))
    kept.refine(queries)
    assert len(kept.parts()) == 2
    # a part without its commit marker counts for nothing; other options have a folder of their own
    lost = os.path.join(kept.parts()[0].removeprefix("file:"), "_SUCCESS")
    os.rename(lost, lost + ".gone")
    assert len(kept.parts()) == 1
    again = kept.refine(queries)
    assert again.count() == points.count() and len(kept.parts()) == 2
    os.rename(lost + ".gone", lost)
    assert len(kept.parts()) == 3 and kept.known().count() == 403 and kept.refine(queries).count() == points.count()
    other = PointTable(spark, tmp_dir, RefineOptions(seed=3))
    assert other.parts() == [] and other.folder != kept.folder
    assert len(whole) == 407


def test_searches_against_large_sets_are_those_in_one_task(spark, table):
    df = table.withColumn("g", F.when(F.col("vec_id") % 3 != 0, "hot").otherwise(F.concat(F.lit("g"), F.col("vec_id") % 5)))
    options = RefineOptions(generations=4, population=8)
    alone = sorted(map(tuple, refine_against_sets(df, "g", options=options).collect()), key=repr)
    parts = sorted(map(tuple, refine_against_sets(df, "g", options=options, chunk_members=10).collect()), key=repr)
    assert alone == parts and len(alone) >= 6
    local = RefineOptions(generations=2, population=5, walk=0.0, diffusion=3)
    assert sorted(map(tuple, refine_against_sets(df, "g", options=local).collect()), key=repr) == \
        sorted(map(tuple, refine_against_sets(df, "g", options=local, chunk_members=7).collect()), key=repr)


def test_joined_queries_are_refined_in_a_bounded_number_of_tasks(spark):
    left = spark.range(2000).select("id", F.array(F.col("id") + 1.0, F.lit(1.0)).alias("query"))
    joined = left.join(spark.range(2000).withColumnRenamed("id", "other"), F.col("id") == F.col("other")) \
        .join(left.select(F.col("id").alias("third")), F.col("id") == F.col("third"))
    once = distinct_queries(joined)
    assert once.rdd.getNumPartitions() == 2 * default_parallelism(spark)
    assert once.count() == 2000
    assert distinct_queries(joined.limit(3)).rdd.getNumPartitions() == 3
    assert distinct_queries(joined.limit(0)).rdd.getNumPartitions() == 1
