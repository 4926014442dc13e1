"""Size-checked broadcast of refined query points.

The scoring tasks need every query point of a search in memory.  A bank is
built only after its size is measured with an aggregate (rows and total
elements of the query vectors); beyond the budget the points are cut into
several banks (:func:`broadcast_banks`), and the rows are scanned once for
each: neither side is ever shuffled to meet the other.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import list_dims, list_to_matrix, sq_norms, unit_rows


@dataclass
class QueryBank:
    """Query points grouped by dimension, plus the queries with no point."""

    size: int
    groups: list                          # [(dim, entry idx (Qd,), points (Qd, d), sq (Qd,))]
    null_idx: np.ndarray                  # entries whose point is NULL
    keys: list = field(default_factory=list)         # Arrow columns that identify the entries
    key_names: list = field(default_factory=list)
    base: int = 0                         # place of the first entry among all banks' entries

    def unit(self, gi: int) -> np.ndarray:
        """Unit-length points of dimension group ``gi`` (cached per worker)."""
        cache = self.__dict__.setdefault("_units", {})
        if gi not in cache:
            _, _, pts, psq = self.groups[gi]
            cache[gi] = unit_rows(pts, psq)
        return cache[gi]

    def __getstate__(self):
        state = dict(self.__dict__)
        state.pop("_units", None)
        return state

    @classmethod
    def from_arrays(cls, points: pa.Array, keys: list | None = None, key_names: list | None = None,
                    base: int = 0) -> "QueryBank":
        dims = list_dims(points)
        groups = []
        for d in np.unique(dims[dims >= 0]):
            idx = np.flatnonzero(dims == d)
            mat, _ = list_to_matrix(points.take(pa.array(idx)), int(d))
            groups.append((int(d), idx, mat, sq_norms(mat)))
        return cls(len(points), groups, np.flatnonzero(dims < 0), keys or [], key_names or [], base)

    @classmethod
    def single(cls, point) -> "QueryBank":
        return cls.from_arrays(pa.array([None if point is None else np.asarray(point, dtype=np.float64)],
                                        type=pa.list_(pa.float64())))


def vector_table_size(df: DataFrame, vec_col: str) -> tuple[int, int]:
    """(rows, total elements) of an array column, from one aggregate job."""
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.greatest(F.coalesce(F.size(F.col(vec_col)), F.lit(0)), F.lit(0)))
                 .alias("e")).collect()[0]
    return int(row["n"] or 0), int(row["e"] or 0)


def estimated_bytes(rows: int, elements: int) -> int:
    # float64 payload, id, norm and per-entry bookkeeping
    return 8 * elements + 32 * rows


def fits_broadcast(rows: int, elements: int, budget: int) -> bool:
    return estimated_bytes(rows, elements) <= budget


def collect_bank(points: DataFrame, point_col: str, key_names: list[str], base: int = 0) -> QueryBank:
    """Collect an already measured ``(key columns, point)`` frame into a bank, in its row order."""
    table = points.select(*key_names, point_col).toArrow()
    return QueryBank.from_arrays(table.column(point_col).combine_chunks(),
                                 [table.column(c).combine_chunks() for c in key_names], key_names, base)


def broadcast_bank(spark, bank: QueryBank):
    return spark.sparkContext.broadcast(bank)


def broadcast_banks(points: DataFrame, point_col: str, key_names: list[str], rows: int, elements: int,
                    budget: int) -> list:
    """Broadcast banks that together hold all points, each of about ``budget`` bytes at most.

    ``points`` must be a written table: it is read once per bank.  Each is
    collected and sent on its own, so the driver holds one at a time.
    """
    spark = points.sparkSession
    parts = max(1, -(-estimated_bytes(rows, elements) // max(budget, 1)))
    parts = max(1, min(parts, rows))
    if parts == 1:
        return [broadcast_bank(spark, collect_bank(points, point_col, key_names))]
    # rows that repeat spread too: the place in the table decides
    dealt = points.withColumn("__part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)))
    out, base = [], 0
    for i in range(parts):
        bank = collect_bank(dealt.filter(F.col("__part") == i), point_col, key_names, base)
        base += bank.size
        if bank.size or not out:
            out.append(broadcast_bank(spark, bank))
    return out
