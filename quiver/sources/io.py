"""Sources, sinks and generators (IO1-IO6).

Reading is Spark's own (``spark.table``, ``spark.read``); these helpers only
fix the vector column's type and name the shapes the engine expects.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def vectors(df: DataFrame, id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """Normalise to ``(id bigint, embedding array<double>)`` plus other columns."""
    return (df.withColumn(id_col, F.col(id_col).cast("bigint"))
            .withColumn(vec_col, F.col(vec_col).cast("array<double>")))


def create_table_as(df: DataFrame, name: str, replace: bool = True, managed: bool = False,
                    fmt: str = "parquet") -> DataFrame:
    """IO4: ``CREATE [OR REPLACE] TABLE name AS SELECT ...``.

    A temporary view by default (nothing is written); ``managed=True``
    writes a catalog table with ``saveAsTable``.
    """
    spark = df.sparkSession
    if managed:
        df.write.mode("overwrite" if replace else "errorifexists").format(fmt).saveAsTable(name)
        return spark.table(name)
    if replace:
        df.createOrReplaceTempView(name)
    else:
        df.createTempView(name)
    return spark.table(name)


def random_vectors(spark: SparkSession, n: int, dim: int = 3, seed: int = 0, start: int = 0,
                   partitions: int | None = None) -> DataFrame:
    """IO5: ``(id, embedding)`` with ``dim`` uniform [0, 1) values per row.

    ``rand(seed)`` depends on the partition layout, which ``spark.range``
    fixes from ``partitions``; same arguments, same table.
    """
    rng = spark.range(start, start + n, numPartitions=partitions) if partitions else \
        spark.range(start, start + n)
    return rng.select(F.col("id"),
                      F.array(*[F.rand(seed * 1000003 + j) for j in range(dim)]).alias("embedding"))


def smoke_vectors(spark: SparkSession, n: int = 32) -> DataFrame:
    """IO6: ``[sin(0.1 i), cos(0.1 i), sin(0.2 i)]`` for i in 0..n-1."""
    i = F.col("id").cast("double")
    return spark.range(n).select(
        F.col("id"),
        F.array(F.sin(i * 0.1), F.cos(i * 0.1), F.sin(i * 0.2)).alias("embedding"))


def smoke_rows(n: int = 32):
    """The same fixture as Python values (for brute-force checks)."""
    return [(i, [math.sin(i * 0.1), math.cos(i * 0.1), math.sin(i * 0.2)]) for i in range(n)]


# Fixed value: the four lineitem measures used as a feature vector.
LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
