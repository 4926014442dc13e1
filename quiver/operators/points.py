"""R4 across queries: a kept table of refined points.

Points depend on the query's values, the options and NumPy's version alone, so
they can be kept: a folder per options and version holds the points in parts,
each written by one call and complete once Spark's commit marker is in it.  A
call refines the queries that no complete part has (an anti-join) and adds
them as a new part.  Calls at the same time may refine a query twice; both
rows are equal and count as one.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.session import attach, materialize
from .refine import REFINED_SCHEMA, refine_queries
from .sfs import RefineOptions


class PointTable:
    """Refined points kept under ``path``, a folder on shared storage."""

    def __init__(self, spark: SparkSession, path: str, options: RefineOptions | None = None):
        attach(spark)
        self.spark, self.options = spark, options or RefineOptions()
        mark = hashlib.sha256(repr((self.options.key(), np.__version__)).encode()).hexdigest()[:16]
        self.folder = f"{path.rstrip('/')}/points-{mark}"

    def parts(self) -> list[str]:
        """The complete parts."""
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(at):
            return []
        found = [s.getPath() for s in fs.listStatus(at) if s.isDirectory()]
        return sorted(p.toString() for p in found if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def known(self) -> DataFrame:
        """``(query, best_point, best_fit)`` of all kept points, a row for each query."""
        parts = self.parts()
        if not parts:
            return self.spark.createDataFrame([], REFINED_SCHEMA)
        rows = self.spark.read.schema(REFINED_SCHEMA).parquet(*parts)
        return rows if len(parts) == 1 else rows.dropDuplicates(["query"])

    def refine(self, queries: DataFrame, query_col: str = "query") -> DataFrame:
        """R1 for the distinct queries of a table; those not kept yet are refined and kept.

        A NULL query, or one with a NULL element, has a NULL point and is not kept.
        """
        query = F.col(query_col).cast("array<double>")
        once = materialize(queries.select(query.alias("query")).dropDuplicates(["query"]), "asked-queries")
        whole = F.col("query").isNotNull() & ~F.exists("query", lambda x: x.isNull())
        known = self.known().withColumnRenamed("query", "k")
        new = materialize(once.filter(whole).join(known.select("k"), F.col("query") == F.col("k"), "left_anti"),
                          "new-queries")
        if not new.isEmpty():
            refine_queries(new, "query", self.options).write.parquet(f"{self.folder}/part-{os.urandom(8).hex()}")
        points = self.known().withColumnRenamed("query", "k")
        return once.join(points, whole & (F.col("query") == F.col("k")), "left").select("query", "best_point", "best_fit")


__all__ = ["PointTable"]
