"""Connected components of a link table, by alternating star contraction.

Every round rewires each node's larger neighbours to its smallest neighbour
(large star), then its smaller ones (small star); the number of rounds grows
with the logarithm of the longest path.  Links stay in tables: each round is
an aggregation and a join, written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import save, small_side


def _rewire(directed: DataFrame, keep) -> DataFrame:
    """Links ``(v, m)`` for the links ``(u, v)`` that ``keep`` selects; m is u's smallest neighbour or u."""
    least = save(directed.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    met = directed.join(small_side(least, 24), "u")
    out = met.filter(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (u, v)``.

    The component is its smallest node.  Loops and repeated links do no harm;
    an empty table gives an empty result.
    """
    now = save(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
               .distinct(), "links")
    while not _stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = save(_rewire(both, F.col("v") > F.col("u")).select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "large-star")
        now = save(_rewire(large, F.col("v") > F.col("m")), "small-star")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _stars(links: DataFrame) -> bool:
    """Whether every node hangs on one other, which hangs on none."""
    roles = (links.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
             .unionByName(links.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))))
    return (roles.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
            .filter("hangs > 1 OR (hangs > 0 AND holds > 0)").isEmpty())
