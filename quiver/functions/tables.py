"""SQL table functions and aggregates: refinement and top-k as part of a query plan.

``register_tables(spark)`` adds to a session:

  fractal_points(TABLE(q)) -> (query, best_point, best_fit)
      R1 / R4: the refined point of every row of a one-column table.  Tasks
      refine their rows together; over ``SELECT DISTINCT`` each distinct query
      is refined once in the whole statement, and the table is joined or used
      as a scalar subquery.
  fractal_population(TABLE(q)) -> (query, particle, point, fit, is_best)
      R3: the final population.
  fractal_explore(query) -> (particle, point, fit, is_best)
      the same for ``LATERAL``: the population of one query value per row.
  nearest_distance(vector, point) -> DOUBLE
      cosine distance in Arrow batches, without refinement.
  nearest_parts(TABLE(group columns, id, vector), point, k) -> (group columns, top_k)
      S2, first step: the k nearest rows of each group among those one task
      holds.  Nothing is shuffled; a task keeps k rows a group.
  nearest_top_k(top_k, k) -> top_k
      S2, second step: an aggregate that merges such lists.
  fractal_search_top_k(vector, id, query, k) -> top_k
      S2 in one step, an aggregate for groups that one task may hold.

``top_k`` is ``array<struct<id, dist>>``, nearest first, ``dist ASC NULLS LAST,
id ASC`` (NaN after numbers).  A constant query is refined once, by a job, into a
session variable; the two steps of a top-k are then one statement::

    DECLARE OR REPLACE VARIABLE search_point ARRAY<DOUBLE>;
    SET VARIABLE search_point = (SELECT best_point FROM fractal_points(TABLE(SELECT :q AS query)));
    SELECT label, nearest_top_k(top_k, 5) AS top_k
    FROM nearest_parts(TABLE(SELECT label, vec_id, embedding FROM embeddings), search_point, 5)
    GROUP BY label
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, StructType

from ..operators.refine import _population_fn, _refine_fn
from ..operators.sfs import RefineOptions, refine
from ..operators.scoring import _Codes
from ..plans.keys import RowKey, built
from ..plans.session import attach
from .selection import NULL, NUMBER, TopKState, classify, keep_first_k
from .sql import score_against_queries

# queries a task collects before it refines them together
TOGETHER = 256
GROUPS, ID = "label int", "vec_id bigint"
POINTS = "query array<double>, best_point array<double>, best_fit double"
POPULATION = "query array<double>, particle int, point array<double>, fit double, is_best boolean"
NAMES = ["fractal_points", "fractal_population", "fractal_explore", "nearest_distance", "nearest_parts",
         "nearest_top_k", "fractal_search_top_k"]


def _table_of(rows: pa.RecordBatch) -> pa.RecordBatch:
    """The columns of a table argument's batch."""
    if rows.num_columns == 1 and pa.types.is_struct(rows.schema.field(0).type):
        return pa.RecordBatch.from_struct_array(rows.column(0))
    return rows


def _refining(run, ddl: str, name: str):
    """A table function class that applies a refinement to the one column of its table argument."""
    def init(self):
        self.held, self.rows = [], 0

    def flushed(self):
        if self.held:
            queries = pa.concat_arrays([c.cast(pa.list_(pa.float64())) for c in self.held])
            self.held, self.rows = [], 0
            for out in run([pa.RecordBatch.from_arrays([queries], names=["query"])]):
                yield pa.Table.from_batches([out])

    def eval(self, rows: pa.RecordBatch):
        column = _table_of(rows).column(0)
        self.held.append(column)
        self.rows += len(column)
        if self.rows >= TOGETHER:
            yield from flushed(self)

    def terminate(self):
        yield from flushed(self)

    made = type(name, (), {"__init__": init, "eval": eval, "terminate": terminate})
    return F.arrow_udtf(made, returnType=ddl)


def _explore(opts: RefineOptions):
    class Explore:
        def eval(self, query):
            if query is None or any(v is None for v in query):
                return
            best, fit, points, fits = refine(np.asarray([query], dtype=np.float64), opts, want_population=True)
            for i, (point, f) in enumerate(zip(points[0], fits[0].tolist())):
                yield i, point.tolist(), f, bool((point == best[0]).all() and f == fit[0])

    return F.udtf(Explore, returnType="particle int, point array<double>, fit double, is_best boolean")


def _lists(ids: pa.Array, dist: np.ndarray, cls: np.ndarray, ends: np.ndarray, typ: pa.DataType) -> pa.Array:
    """Lists of ``(id, dist)`` that end at the given places."""
    shown = pa.array(np.where(cls == NUMBER, dist, np.nan), pa.float64(), mask=cls == NULL)
    items = pa.StructArray.from_arrays([ids, shown], fields=list(typ.value_type))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), items).cast(typ)


def _parts(groups: StructType, key: RowKey, out: StructType):
    """The table function of the first step, for given group columns and id."""
    types = [to_arrow_type(f.dataType) for f in out.fields]
    n_groups = len(groups.fields)

    class NearestParts:
        def __init__(self):
            self.codes, self.places, self.groups, self.state = [_Codes() for _ in range(n_groups)], {}, [] if n_groups else [()], None

        def eval(self, rows: pa.RecordBatch, point: pa.Array, k: pa.Array):
            batch = _table_of(rows)
            if not batch.num_rows:
                return
            point = (point.column(0) if isinstance(point, pa.RecordBatch) else point).cast(pa.list_(pa.float64()))
            k = int((k.column(0) if isinstance(k, pa.RecordBatch) else k)[0].as_py())
            # NULL_dist rows stay: they are last, but a group may have no others
            dist = score_against_queries(batch.column(n_groups + 1).cast(pa.list_(pa.float64())), point, None, True)
            raw = dist.to_numpy(zero_copy_only=False)
            cls, filled = classify(raw)
            cls[np.flatnonzero(dist.is_null().to_numpy(zero_copy_only=False))] = NULL
            code = self._group(batch)
            if self.state is None:
                self.state = TopKState(0, k)
            ids = key.read(pa.RecordBatch.from_arrays([batch.column(n_groups)], names=key.inner))
            pick = keep_first_k([code], cls, filled, built(ids), k)
            self.state.add([code[pick]], cls[pick], filled[pick], built(ids[pick]))
            yield from ()

        def _group(self, batch: pa.RecordBatch) -> np.ndarray:
            if not n_groups:
                return np.zeros(batch.num_rows, dtype=np.int64)
            columns = np.stack([c.encode(batch.column(i)) for i, c in enumerate(self.codes)], axis=1)
            uniq, inverse = np.unique(columns, axis=0, return_inverse=True)
            place = []
            for row in map(tuple, uniq.tolist()):
                if row not in self.places:
                    self.places[row] = len(self.groups)
                    self.groups.append(row)
                place.append(self.places[row])
            return np.array(place, dtype=np.int64)[inverse.reshape(-1)]

        def terminate(self):
            kept = self.state.result() if self.state else None
            if kept is None:
                return
            (code,), cls, dist, ids = kept
            order = keep_first_k([code], cls, dist, ids, len(ids))
            code, cls, dist, ids = code[order], cls[order], dist[order], ids[order]
            first = np.flatnonzero(np.diff(code, prepend=-1))
            each = [self.groups[c] for c in code[first].tolist()]
            columns = [self.codes[i].decode(np.array([g[i] for g in each]), types[i]) for i in range(n_groups)]
            ends = np.append(first[1:], len(code))
            yield pa.Table.from_arrays([*columns, _lists(key.write(ids)[0], dist, cls, ends, types[-1])], names=out.names)

    return F.arrow_udtf(NearestParts, returnType=out)


def _first_k(ids: pa.Array, dist: pa.Array, key: RowKey, k: int) -> list[dict]:
    read = built(key.read(pa.RecordBatch.from_arrays([ids], names=key.inner)))
    raw = dist.to_numpy(zero_copy_only=False)
    cls, filled = classify(raw)
    cls[np.flatnonzero(dist.is_null().to_numpy(zero_copy_only=False))] = NULL
    pick = pa.array(keep_first_k([], cls, filled, read, k))
    name = key.names[0]
    return [{name: i, "dist": d} for i, d in zip(ids.take(pick).to_pylist(), dist.take(pick).to_pylist())]


def register_tables(spark: SparkSession, options: RefineOptions | None = None, groups: str = GROUPS,
                    id_ddl: str = ID) -> list[str]:
    """Add the functions above to a session; returns their names.

    ``groups`` and ``id_ddl`` are the group columns (any number, also none)
    and the id that ``nearest_parts`` takes before the vector, as DDL.
    """
    attach(spark)
    opts = options or RefineOptions()
    spark.udtf.register("fractal_points", _refining(_refine_fn(opts), POINTS, "Points"))
    spark.udtf.register("fractal_population", _refining(_population_fn(opts), POPULATION, "Population"))
    spark.udtf.register("fractal_explore", _explore(opts))

    def nearest_distance(vector: pa.Array, point: pa.Array) -> pa.Array:
        return score_against_queries(vector, point, None, True)

    spark.udf.register("nearest_distance", F.arrow_udf(nearest_distance, DoubleType()))
    ids = StructType.fromDDL(id_ddl)
    if len(ids.fields) != 1:
        raise ValueError("nearest_parts takes one id column")
    group_fields = StructType.fromDDL(groups) if groups else StructType()
    item = f"array<struct<{id_ddl.split()[0]}:{ids.fields[0].dataType.simpleString()},dist:double>>"
    out = StructType([*group_fields.fields, *StructType.fromDDL(f"top_k {item}").fields])
    key = RowKey(spark.createDataFrame([], ids), ids.names[0])
    spark.udtf.register("nearest_parts", _parts(group_fields, key, out))

    def nearest_top_k(lists: pa.Array, k: pa.Array) -> list:
        flat = lists.flatten()
        return _first_k(flat.field(0), flat.field(1), key, k[0].as_py())

    def fractal_search_top_k(vector: pa.Array, id: pa.Array, query: pa.Array, k: pa.Array) -> list:
        return _first_k(id, score_against_queries(vector, query, opts), key, k[0].as_py())

    for f in (nearest_top_k, fractal_search_top_k):
        spark.udf.register(f.__name__, F.arrow_udf(f, item, ArrowUDFType.GROUPED_AGG))
    return list(NAMES)
