"""What the vector searches share: valid rows, query blocks, ranking."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.session import scratch_path
from .shared import save

# queries whose vectors one broadcast holds
BLOCK_BYTES = 8 << 20


def usable(vec: Column) -> Column:
    """Not null, not empty, and every component a finite number."""
    return vec.isNotNull() & (F.size(vec) > 0) & F.forall(
        vec, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def in_query_blocks(queries: DataFrame, dim: int, run: Callable[[pa.Table], tuple[DataFrame, Broadcast]],
                    name: str) -> DataFrame:
    """The union of ``run`` over blocks of ``queries``; each block fits a broadcast.

    ``run`` gets a block as an Arrow table and gives its result and the
    broadcast it reads, which is released once the result is written to the
    shared folder: one block at a time is in memory, here and on executors.
    """
    spark = queries.sparkSession
    queries = save(queries.withColumn("h", F.xxhash64(*queries.columns)), f"{name}-queries")
    n = queries.count()
    blocks = max(1, -(-n * (8 * dim + 64) // BLOCK_BYTES))
    path, schema = scratch_path(spark, name), None
    for b in range(blocks):
        part = queries if blocks == 1 else queries.filter(F.pmod("h", F.lit(blocks)) == b)
        out, held = run(part.drop("h").toArrow())
        schema = out.schema
        out.write.mode("append").parquet(path)
        held.destroy()
    return spark.read.schema(schema).parquet(path)


def best_per_query(found: DataFrame, k: int, score_type: str, *then: Column) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best, ties by ``then`` and to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), *then, F.col("vec_id").asc())
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", F.col("score").cast(score_type).alias("score")))
