"""Physical plan shapes: pruning, pushdown, shuffles and group limits."""

import math

from pyspark.sql import functions as F

from quiver import fractal_distance, search, search_groups, search_many
from quiver.operators.setdist import min_distance_to_set
from quiver.plans.explain import count_nodes, plan_text, pushed_filters, read_schemas

from conftest import SF001

Q = [math.sin(j + 1.0) for j in range(64)]


def _emb(spark):
    return spark.read.parquet(f"{SF001}/embeddings.parquet")


def test_single_query_search_prunes_pushes_and_does_not_shuffle(spark):
    df = search(_emb(spark).filter(F.col("label") == 3), Q, 10, id_col="vec_id")
    # the filter column is read for the pushed predicate; nothing else beyond id + vector
    assert read_schemas(df) == ["struct<vec_id:bigint,embedding:array<float>,label:int>"]
    assert pushed_filters(df) == ["IsNotNull(label), EqualTo(label,3)"]
    assert count_nodes(df, "MapInArrow") == 1
    assert count_nodes(df, "TakeOrderedAndProject") == 1
    assert count_nodes(df, "Exchange") == 0                    # per-task top-k, one merge


def test_projection_prunes_payload_columns(spark):
    df = search(_emb(spark), Q, 10, id_col="vec_id")
    assert read_schemas(df) == ["struct<vec_id:bigint,embedding:array<float>>"]
    sc = fractal_distance(_emb(spark).select("vec_id", "embedding"), Q)
    assert read_schemas(sc) == ["struct<vec_id:bigint,embedding:array<float>>"]
    assert count_nodes(sc, "Exchange") == 0


def test_group_top_k_is_partial_then_final_group_limit(spark):
    df = search_groups(_emb(spark), Q, "label", 5, id_col="vec_id")
    text = plan_text(df, "simple")
    assert "WindowGroupLimit" in text and "Partial" in text and "Final" in text
    assert count_nodes(df, "Exchange") == 1                    # one shuffle, on the group key
    assert "hashpartitioning(__g" in text


def test_many_queries_shuffle_only_candidates(spark):
    emb = _emb(spark)
    qs = emb.filter("vec_id < 4").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    df = search_many(emb, qs, 5, id_col="vec_id")
    text = plan_text(df, "simple")
    assert count_nodes(df, "Exchange") == 1 and "hashpartitioning(__q" in text
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_set_distance_broadcast_path_has_no_shuffle(spark):
    emb = _emb(spark)
    df = min_distance_to_set(emb, emb.filter("label = 0"), id_col="vec_id")
    assert count_nodes(df, "Exchange") == 0
    assert "CartesianProduct" not in plan_text(df, "simple")


def test_vector_broadcast_plan_has_no_window_shuffle(spark):
    emb = _emb(spark)
    qs = emb.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    df = search_many(emb, qs, 5, id_col="vec_id", exact=True, broadcast_bytes=1,
                     vector_broadcast_bytes=1 << 26)
    text = plan_text(df, "simple")
    assert count_nodes(df, "Exchange") == 1 and "xxhash64(__k0" in text       # the query spread
    assert "Window" not in text and "CartesianProduct" not in text


def test_hot_group_ships_at_most_k_per_task(spark):
    """A group holding 90% of the rows sends no more than k rows per task."""
    import pyarrow as pa

    from quiver.operators.scoring import VectorSpec, candidate_ddl, topk_scorer
    from quiver.plans.bank import QueryBank, broadcast_bank
    from quiver.plans.keys import RowKey

    emb = _emb(spark).withColumn("g", F.when(F.col("vec_id") % 10 == 0, F.col("label")).otherwise(-1))
    parts = 6
    df = emb.repartition(parts, "vec_id")
    k = 4
    bank_bc = broadcast_bank(spark, QueryBank.single(Q))
    spec, key = VectorSpec("embedding"), RowKey(df, "vec_id")
    cands = df.select(*key.select(), *spec.select(), F.col("g").alias("__g")).mapInArrow(
        topk_scorer(bank_bc, spec.inner(), key, k, group_type=pa.int32()),
        candidate_ddl(key, group_type="int"))
    per_task = cands.groupBy(F.spark_partition_id().alias("p"), "__g").count().collect()
    assert max(r["count"] for r in per_task) <= k
    n_groups = emb.select("g").distinct().count()
    assert cands.count() <= parts * n_groups * k
    got = search_groups(df, Q, "g", k, id_col="vec_id").filter("g = -1").count()
    assert got == k


def test_building_a_grouped_search_runs_nothing(spark):
    """A shuffle below the search is not executed to plan it."""
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    emb = _emb(spark).select("vec_id", "label", "embedding")
    below = emb.mapInArrow(touch, emb.schema).repartition(7, "vec_id")
    df = search_groups(below, Q, "label", 5, id_col="vec_id")
    assert seen.value == 0
    df.collect()
    assert seen.value == emb.count()


def test_many_queries_are_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    emb = _emb(spark)
    qs = emb.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")).filter("query_id < 40")
    counted = qs.mapInArrow(touch, qs.schema)
    for budget in (1 << 26, 4000):
        seen.value = 0
        search_many(emb, counted, 3, id_col="vec_id", exact=True, broadcast_bytes=budget).collect()
        assert seen.value == qs.count()


def test_group_top_k_by_key_limits_before_the_shuffle(spark):
    emb = _emb(spark).withColumn("key", F.format_string("k%04d", "vec_id"))
    df = search_groups(emb, Q, "label", 5, id_col="key")
    text = plan_text(df, "simple")
    assert "WindowGroupLimit" in text and "Partial" in text and "Final" in text
    assert count_nodes(df, "Exchange") == 1
