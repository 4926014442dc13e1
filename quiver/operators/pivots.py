"""S1m where both tables are large: an exact k-nearest join with pivots.

Vectors are dealt to the cell of their nearest pivot (by angle) and packed, in
order of that angle, into blocks: rings around a pivot.  The triangle inequality
of angles bounds how near a row of a ring can be to a query, so a query meets
its own cell first, learns its k-th distance there, and afterwards only cells
and rings that can hold something as near.  ``search_many`` meets every pair
instead, and needs no shuffle of the vectors; here both sides are shuffled once
(queries once per visited cell), which pays where vectors are clustered.

Cells decide how much is skipped, never what is found: bounds carry a margin for
rounding, and distances and ties are those of :func:`search_many`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ..functions.arrays import (cosine_to_points, doubtful, exact_cosine, list_dims, list_to_matrix,
                               screen_margin, sq_norms, unit_rows)
from ..functions.selection import classify, keep_first_k
from ..plans.bank import vector_table_size
from ..plans.keys import RowKey, built, quoted
from ..plans.session import DEFAULT_BROADCAST_BYTES, default_parallelism, materialize
from ..plans.topk import top_k_per_key
from .scoring import VectorSpec, _screen
from .search import _query_names, _require_k, _spark, _vector_column, query_points, search_many

PIVOTS = 1024               # cells per vector length, at most
SAMPLE_ROWS = 20_000        # rows the pivots are fitted on; all rows are dealt and searched
SAMPLE_VALUES = 1 << 21     # and their elements
PIVOT_LENGTHS = 64          # vector lengths with fitted pivots; others are one cell each
FIT_ROUNDS = 5
BLOCK_VALUES = 1 << 17      # vector elements of a block of rows
BLOCK_ROWS = 4096
BLOCK_QUERIES = 512
BLOCKS_PER_PART = 8         # blocks of a cell that meet the cell's queries in one task
VISIT_VALUES = 1 << 21      # elements of query vectors in one batch of visits
QUERY_SALT = 16
ROWS_PER_TASK = 200_000
SECOND_ROUND = 8            # cells between the home cells and the rest
SCAN_SHARE = 0.5            # of all pairs left after the first round: beyond, rows are scanned instead

NEVER, ALWAYS = -2, -1      # cells of rows without a number, and of rows without a bound


# ---------------------------------------------------------------- pivots and cells

def fit_pivots(units: np.ndarray, count: int) -> np.ndarray:
    """``count`` unit vectors at most: a few rounds of spherical k-means over sampled unit rows."""
    rng = np.random.default_rng(7)
    count = max(1, min(count, len(units)))
    pivots = units[rng.choice(len(units), count, replace=False)]
    for _ in range(FIT_ROUNDS):
        near = np.argmax(units @ pivots.T, axis=1)
        sums = np.zeros_like(pivots)
        np.add.at(sums, near, units)
        sq = sq_norms(sums)
        moved = sq > 0
        pivots = np.where(moved[:, None], unit_rows(sums, np.where(moved, sq, 1.0)), pivots)
    return pivots


def _kinds(mat: np.ndarray):
    """(rows with a bound, rows that give numbers but have none, zero rows, squared norms)."""
    with np.errstate(over="ignore", invalid="ignore"):
        sq = sq_norms(mat)
    finite = np.isfinite(mat).all(axis=1)
    zero = finite & (sq == 0)
    odd = finite & ~zero & doubtful(sq)
    return finite & ~zero & ~odd, odd, zero, sq


def _pivots_of(pivots: dict, dim: int) -> np.ndarray:
    held = pivots.get(dim)
    return np.eye(1, dim) if held is None else held


def _angles(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ pivots.T, -1.0, 1.0))


def angle_margin(dim: int) -> float:
    """More than the rounding of three angles: near 0 an arc cosine magnifies an error e to sqrt(2 e)."""
    return 8.0 * float(np.sqrt(2.0 * screen_margin(dim)))


def _placed(pivots_bc, key: RowKey):
    """Each row with its length, cell and angle to the cell's pivot."""

    def run(batches):
        pivots = pivots_bc.value
        for batch in batches:
            dims = list_dims(batch.column("__v"))
            for dim in np.unique(dims[dims >= 0]):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                mat, _ = list_to_matrix(part.column("__v"), int(dim))
                plain, odd, zero, sq = _kinds(mat)
                cells = np.full(len(mat), NEVER, dtype=np.int32)
                angles = np.zeros(len(mat))
                cells[odd | zero] = ALWAYS
                rows = np.flatnonzero(plain)
                mine = _pivots_of(pivots, int(dim))
                step = max(1, (1 << 22) // len(mine))
                for lo in range(0, len(rows), step):
                    at = rows[lo:lo + step]
                    near = _angles(unit_rows(mat[at], sq[at]), mine)
                    cells[at] = near.argmin(axis=1)
                    angles[at] = near[np.arange(len(at)), cells[at]]
                columns = [part.column(c) for c in key.inner + ["__v"]]
                columns += [pa.array(np.full(len(mat), dim, dtype=np.int32)), pa.array(cells), pa.array(angles),
                            pa.array(zero)]
                out = pa.RecordBatch.from_arrays(columns, names=key.inner + ["__v", "__n", "__c", "__t", "__zero"])
                yield out.filter(pa.array(cells != NEVER))

    return run


def _runs(dims: np.ndarray, cells: np.ndarray, longest) -> list[tuple[int, int]]:
    """Places [lo, hi) of equal (length, cell), none longer than ``longest(length)``."""
    if not len(dims):
        return []
    cut = np.flatnonzero((np.diff(dims) != 0) | (np.diff(cells) != 0)) + 1
    out = []
    for lo, hi in zip(np.append(0, cut), np.append(cut, len(dims))):
        step = longest(int(dims[lo]))
        out += [(int(a), int(min(a + step, hi))) for a in range(lo, hi, step)]
    return out


def _packed_rows(key: RowKey):
    """Sorted rows as blocks: one row per run of a cell, its keys as lists, its vectors as doubles."""

    def longest(dim):
        return max(1, min(BLOCK_ROWS, BLOCK_VALUES // max(dim, 1)))

    def run(batches):
        for batch in batches:
            dims, cells = (np.asarray(batch.column(c)) for c in ("__n", "__c"))
            angles = np.asarray(batch.column("__t"))
            runs = _runs(dims, cells, longest)
            if not runs:
                continue
            offsets = pa.array(np.append([lo for lo, _ in runs], runs[-1][1]).astype(np.int32))
            vectors = [list_to_matrix(batch.column("__v").slice(lo, hi - lo), int(dims[lo]))[0].tobytes()
                       for lo, hi in runs]
            at = np.array([lo for lo, _ in runs])
            bounded = cells[at] >= 0
            columns = [pa.ListArray.from_arrays(offsets, batch.column(c)) for c in key.inner]
            columns += [pa.array(vectors, pa.binary()), pa.array(dims[at]), pa.array(cells[at]),
                        pa.array(np.where(bounded, [angles[lo:hi].min() for lo, hi in runs], 0.0)),
                        pa.array(np.where(bounded, [angles[lo:hi].max() for lo, hi in runs], np.pi))]
            yield pa.RecordBatch.from_arrays(columns, names=key.inner + ["__v", "__n", "__c", "__lo", "__hi"])

    return run


# ---------------------------------------------------------------- queries and visits

def _query_kinds(batches):
    """The length of queries that have a bound; -1 for all others."""
    for batch in batches:
        points = batch.column("__p")
        dims = list_dims(points)
        kind = np.full(len(dims), -1, dtype=np.int32)
        for dim in np.unique(dims[dims >= 0]):
            at = np.flatnonzero(dims == dim)
            mat, _ = list_to_matrix(points.take(pa.array(at)), int(dim))
            kind[at[_kinds(mat)[0]]] = dim
        yield pa.RecordBatch.from_arrays([batch.column("__q"), points, pa.array(kind)], names=["__q", "__p", "__n"])


def _by_bound(pivots: dict, cells: dict, dim: int, units, cut, k: int):
    """Per query the cells in the order of their bounds, and what decides about them.

    ``(cells, rows of each, angles to their pivots, order, bounds in that order,
    number of cells until k rows are met, reach)``; without a cut the reach is
    beyond any angle.
    """
    held = cells.get(dim)
    if held is None:
        held = np.array([0]), np.array([0.0]), np.array([np.pi]), np.array([k])
    ids, lo, hi, rows = held
    phi = _angles(units, _pivots_of(pivots, dim)[ids])
    bound = np.maximum(0.0, np.maximum(phi - hi, lo - phi))
    order = np.lexsort((phi, bound), axis=1)
    enough = (np.cumsum(rows[order], axis=1) < k).sum(axis=1) + 1
    reach = np.where(np.isnan(cut), 4.0, np.arccos(np.clip(1.0 - cut, -1.0, 1.0)) + angle_margin(dim))
    return ids, rows, phi, order, np.take_along_axis(bound, order, axis=1), enough, reach


def _by_length(batch: pa.RecordBatch, pivots: dict):
    """A batch's queries in bounded pieces of one length: (length, places, unit vectors, cuts)."""
    dims = np.asarray(batch.column("__n"))
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        step = max(1, VISIT_VALUES // (max(dim, 1) * len(_pivots_of(pivots, dim))))
        for lo in range(0, len(at), step):
            some = pa.array(at[lo:lo + step])
            mat, _ = list_to_matrix(batch.column("__p").take(some), dim)
            cut = batch.column("__cut").take(some).to_numpy(zero_copy_only=False)
            yield dim, at[lo:lo + step], unit_rows(mat), np.asarray(cut, dtype=np.float64)


def _pairs_left(pivots_bc, cells_bc, k: int):
    """Pairs in the cells that the rounds after the first would meet."""

    def run(batches):
        for batch in batches:
            left = 0
            for dim, _, units, cut in _by_length(batch, pivots_bc.value):
                _, rows, _, order, bound, enough, reach = _by_bound(pivots_bc.value, cells_bc.value, dim, units, cut, k)
                later = (np.arange(len(rows)) >= enough[:, None]) & (bound <= reach[:, None])
                left += int((rows[order] * later).sum())
            yield pa.RecordBatch.from_arrays([pa.array([left], pa.int64())], names=["__m"])

    return run


def _visits(pivots_bc, cells_bc, k: int, turn: int):
    """The cells each query meets in a round: (query, length, cell, angle to the pivot, reach, cut, vector).

    Round 0 takes as many cells, in the order of their bounds, as hold k rows,
    round 1 the next few, round 2 the rest; later rounds leave out what lies
    beyond the k-th distance found so far.
    """

    def run(batches):
        for batch in batches:
            for dim, at, units, cut in _by_length(batch, pivots_bc.value):
                ids, _, phi, order, bound, enough, reach = _by_bound(
                    pivots_bc.value, cells_bc.value, dim, units, cut, k)
                place = np.arange(len(ids))
                first = (np.zeros_like(enough), enough, enough + SECOND_ROUND)[turn]
                last = (enough, enough + SECOND_ROUND, np.full_like(enough, len(ids)))[turn]
                q, nth = np.nonzero((place >= first[:, None]) & (place < last[:, None]) & (bound <= reach[:, None]))
                cell = order[q, nth]
                angle, cell = phi[q, cell], ids[cell]
                if turn == 0:
                    # rows without a bound meet every query
                    q = np.concatenate([q, np.arange(len(units))])
                    cell = np.concatenate([cell, np.full(len(units), ALWAYS)])
                    angle = np.concatenate([angle, np.zeros(len(units))])
                if not len(q):
                    continue
                rows = pa.array(at[q])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("__q").take(rows), pa.array(np.full(len(q), dim, dtype=np.int32)),
                     pa.array(cell.astype(np.int32)), pa.array(angle), pa.array(reach[q]), pa.array(cut[q]),
                     batch.column("__p").take(rows)],
                    names=["__q", "__n", "__c", "__phi", "__reach", "__cut", "__p"])

    return run


def _packed_queries(batches):
    """Visits of one cell as blocks of queries."""
    for batch in batches:
        dims, cells = (np.asarray(batch.column(c)) for c in ("__n", "__c"))
        runs = _runs(dims, cells, lambda dim: max(1, min(BLOCK_QUERIES, BLOCK_VALUES // max(dim, 1))))
        if not runs:
            continue
        at = np.array([lo for lo, _ in runs])
        numbers = [pa.array([np.asarray(batch.column(c))[lo:hi].tobytes() for lo, hi in runs], pa.binary())
                   for c in ("__q", "__phi", "__reach", "__cut")]
        points = pa.array([list_to_matrix(batch.column("__p").slice(lo, hi - lo), int(dims[lo]))[0].tobytes()
                           for lo, hi in runs], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(dims[at]), pa.array(cells[at]), *numbers, points],
            names=["__n", "__c", "__q", "__phi", "__reach", "__cut", "__p"])


def _met(key: RowKey, k: int):
    """Blocks of queries against blocks of rows: the k first candidates per query and batch.

    One row with query -1 carries, in ``__m``, the number of pairs met.
    """

    def run(batches):
        for batch in batches:
            lists = [batch.column(c) for c in key.inner]
            offsets = np.asarray(lists[0].offsets)
            dims, lo, hi = (np.asarray(batch.column(c)) for c in ("__n", "__lo", "__hi"))
            queries, rows, found, pairs = [], [], [], 0
            for i in range(batch.num_rows):
                q = np.frombuffer(batch.column("__q")[i].as_buffer(), np.int64)
                phi, reach, cut = (np.frombuffer(batch.column(c)[i].as_buffer(), np.float64)
                                   for c in ("__phi", "__reach", "__cut"))
                alive = np.flatnonzero(np.maximum(phi - hi[i], lo[i] - phi) <= reach)
                if not len(alive):
                    continue
                dim = int(dims[i])
                points = np.frombuffer(batch.column("__p")[i].as_buffer(), np.float64).reshape(-1, dim)[alive]
                mat = np.frombuffer(batch.column("__v")[i].as_buffer(), np.float64).reshape(-1, dim)
                pairs += len(alive) * len(mat)
                with np.errstate(over="ignore", invalid="ignore"):
                    msq, psq = sq_norms(mat), sq_norms(points)
                    D = cosine_to_points(mat, points, msq, psq)
                r, c = _screen(D, k, screen_margin(dim), cut[alive], doubtful(msq))
                with np.errstate(over="ignore", invalid="ignore"):
                    d = exact_cosine(mat[r], points[c])
                number = ~np.isnan(d)
                queries.append(q[alive][c[number]])
                rows.append(offsets[i] + r[number])
                found.append(d[number])
            q = np.concatenate(queries) if queries else np.empty(0, np.int64)
            at = np.concatenate(rows) if rows else np.empty(0, np.int64)
            d = np.concatenate(found) if found else np.empty(0)
            keys = pa.RecordBatch.from_arrays([x.values.take(pa.array(at, pa.int64())) for x in lists], names=key.inner)
            cls, dist = classify(d)
            keep = keep_first_k([q], cls, dist, built(key.read(keys)), k)
            columns = [pa.array(np.append(q[keep], -1))]
            columns += [pa.concat_arrays([x.take(pa.array(keep, pa.int64())), pa.nulls(1, x.type)]) for x in keys.columns]
            columns += [pa.array(np.append(d[keep], 0.0)), pa.array(np.append(np.zeros(len(keep), np.int64), pairs))]
            yield pa.RecordBatch.from_arrays(columns, names=["__q", *key.inner, "__d", "__m"])

    return run


# ---------------------------------------------------------------- the join

def _cells(placed: DataFrame) -> DataFrame:
    return placed.filter("__c >= 0").groupBy("__n", "__c").agg(
        F.min("__t").alias("lo"), F.max("__t").alias("hi"), F.count(F.lit(1)).alias("rows"))


def _fitted(frame: DataFrame, rows: int, elements: int) -> dict:
    """Pivots by vector length, fitted on a bounded sample."""
    wanted = max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // max(1, -(-elements // max(rows, 1)))))
    share = min(1.0, 2.0 * wanted / max(rows, 1))
    sample = frame.select("__v").filter("__v IS NOT NULL").sample(False, share, 7).limit(wanted).toArrow()
    vectors = sample.column("__v").combine_chunks()
    dims = list_dims(vectors)
    lengths, counts = np.unique(dims[dims > 0], return_counts=True)
    out = {}
    for dim in lengths[np.argsort(-counts, kind="stable")][:PIVOT_LENGTHS].tolist():
        mat, _ = list_to_matrix(vectors, dim)
        plain, _, _, sq = _kinds(mat)
        if plain.any():
            out[dim] = fit_pivots(unit_rows(mat[plain], sq[plain]), min(PIVOTS, int(np.sqrt(rows))))
    return out


def _joined(vectors, queries, k, vec, id_col, query_id_col, query_col, options, exact, dist_col, broadcast_bytes,
            scan_share):
    _require_k(k)
    spark = _spark(vectors)
    spec, key = VectorSpec(vec), RowKey(vectors, id_col)
    query_key = RowKey(queries, query_id_col, "__k")
    names = _query_names(query_key, key)

    points, _, _ = query_points(queries, query_key, query_col, options, exact, broadcast_bytes)
    held = materialize(points.withColumn("__q", F.monotonically_increasing_id()), "pivot-queries")
    kind = held.schema["__p"].dataType.simpleString()
    kinds = materialize(held.select("__q", "__p").mapInArrow(_query_kinds, f"__q long, __p {kind}, __n int"),
                        "pivot-kinds")

    vector = _vector_column(spec)
    if spec.array_col and isinstance(vectors.schema[spec.array_col].dataType, ArrayType) \
            and isinstance(vectors.schema[spec.array_col].dataType.elementType, FloatType):
        vector = quoted(spec.array_col)         # half the bytes; kernels widen exactly
    frame = vectors.select(*key.select(), vector.alias("__v"))
    rows, elements = vector_table_size(frame, "__v")
    pivots_bc = spark.sparkContext.broadcast(_fitted(frame, rows, elements))
    kind = frame.schema["__v"].dataType.simpleString()
    placed = materialize(frame.mapInArrow(
        _placed(pivots_bc, key), f"{key.ddl}, __v {kind}, __n int, __c int, __t double, __zero boolean"), "pivot-placed")
    cells = materialize(_cells(placed), "pivot-cells")

    # fitted lengths only: PIVOT_LENGTHS x PIVOTS rows at most
    table = cells.filter(F.col("__n").isin(list(pivots_bc.value) or [-1])).toArrow().to_pandas()
    cells_bc = spark.sparkContext.broadcast({
        int(n): tuple(g[c].to_numpy() for c in ("__c", "lo", "hi", "rows")) for n, g in table.groupby("__n")})

    # all zero rows of a length are equally far from everything: the first k stand for them
    zeros = Window.partitionBy("__n").orderBy(*key.order())
    kept = placed.filter("NOT __zero").unionByName(
        placed.filter("__zero").withColumn("__r", F.row_number().over(zeros)).filter(F.col("__r") <= k).drop("__r"))
    order = ["__n", "__c", "__t", F.xxhash64(*key.inner)]
    tasks = max(2 * default_parallelism(spark), -(-rows // ROWS_PER_TASK))
    key_lists = ", ".join(f"`{a}` array<{t.simpleString()}>" for a, t in zip(key.inner, key.types))
    blocks = materialize(kept.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(
        _packed_rows(key), f"{key_lists}, __v binary, __n int, __c int, __lo double, __hi double"), "pivot-blocks")
    parts = materialize(blocks.groupBy("__n", "__c").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(BLOCKS_PER_PART)).cast("int").alias("__parts")), "pivot-parts")
    dealt = (blocks.withColumn("__h", F.xxhash64("__v", "__lo")).join(parts, ["__n", "__c"])
             .withColumn("__part", F.pmod("__h", F.col("__parts")).cast("int")).drop("__h", "__parts"))

    # a query takes part here if k rows of its length have a bound; the others are few vectors, searched plainly
    enough = cells.groupBy("__n").agg(F.sum("rows").alias("rows")).filter(F.col("rows") >= k).select("__n")
    asked = kinds.join(enough, "__n", "left_semi").withColumn("__cut", F.lit(None).cast("double"))
    rest = kinds.join(enough, "__n", "left_anti").select("__q", "__p")

    def scanned(points, name):
        out = search_many(vectors, points, k, vec, id_col, name, "__p", exact=True, dist_col="__d",
                          broadcast_bytes=broadcast_bytes)
        return out.select(name, F.col("rank").alias("__r"), *key.select(), "__d")

    met_ddl = f"__q long, {key.ddl}, __d double, __m long"
    wide = asked.schema["__p"].dataType.simpleString()
    found, pairs = None, 0
    most = max([1, *(len(held[0]) for held in cells_bc.value.values())])
    for turn, seen in enumerate((0, 1, 1 + SECOND_ROUND)):
        if seen and most <= seen:
            break                           # earlier rounds met every cell
        if turn:
            cut = found.groupBy("__q").agg(F.max("__d").alias("__cut"))
            asked = asked.drop("__cut").join(cut, "__q")
        if turn == 1:
            left = asked.select("__p", "__n", "__cut").mapInArrow(_pairs_left(pivots_bc, cells_bc, k), "__m long")
            if (left.agg(F.sum("__m")).first()[0] or 0) > scan_share * found.select("__q").distinct().count() * rows:
                # bounds leave most pairs: one plain scan without a shuffle of the vectors meets them for less
                found = scanned(asked.select("__q", "__p"), "__q").select(found.columns)
                pairs = asked.count() * rows
                break
        visits = asked.select("__q", "__p", "__n", "__cut").mapInArrow(
            _visits(pivots_bc, cells_bc, k, turn),
            f"__q long, __n int, __c int, __phi double, __reach double, __cut double, __p {wide}")
        packed = (visits.repartition("__n", "__c", F.pmod("__q", F.lit(QUERY_SALT)))
                  .sortWithinPartitions("__n", "__c").mapInArrow(
                      _packed_queries, "__n int, __c int, __q binary, __phi binary, __reach binary, __cut binary, "
                                       "__p binary"))
        spread = packed.join(parts, ["__n", "__c"]).withColumn(
            "__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))).drop("__parts")
        new = materialize(spread.join(dealt, ["__n", "__c", "__part"]).select(
            *key.inner, "__v", dealt["__n"], "__lo", "__hi", "__q", "__phi", "__reach", "__cut", "__p")
            .mapInArrow(_met(key, k), met_ddl), "pivot-met")
        pairs += new.agg(F.sum("__m")).first()[0] or 0
        cands = new.filter("__q >= 0").drop("__m")
        if found is not None:
            cands = found.drop("__r").unionByName(cands)
        found = materialize(top_k_per_key(cands, ["__q"], key, k), "pivot-found")

    # every round is written: nothing that runs later reads these
    pivots_bc.destroy()
    cells_bc.destroy()

    if not rest.isEmpty():
        # equal vectors have equal neighbours: each is searched once
        each = materialize(rest.select("__p").dropDuplicates().withColumn("__u", F.monotonically_increasing_id()),
                           "pivot-rest")
        plain = scanned(each, "__u")
        mine = rest.join(each.withColumnRenamed("__p", "__p2"), F.col("__p").eqNullSafe(F.col("__p2")))
        found = found.unionByName(mine.select("__q", "__u").join(plain, "__u").select(found.columns))

    out = held.select("__q", *query_key.inner).join(found, "__q").select(
        *query_key.restore(names), F.col("__r").alias("rank"), *key.restore(), F.col("__d").alias(dist_col))
    return out, kinds, cells, rows, pairs


def pivot_search_many(vectors: DataFrame, queries: DataFrame, k: int = 10, vec="embedding", id_col="id",
                      query_id_col="query_id", query_col: str = "query", options=None, exact: bool = False,
                      dist_col: str = "dist", broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                      scan_share: float = SCAN_SHARE) -> DataFrame:
    """S1m for two large tables: the same ``(query key, rank, row key, dist)`` as ``search_many``.

    Rounds run when called, as their cuts depend on each other; tables between
    them are written to the checkpoint folder.  NULL, zero, non-finite and
    very large or small query vectors, and queries of a length with fewer than
    k ordinary rows, have no useful bound: their distinct vectors go through
    ``search_many``.  So do all queries if, after the first round, the bounds
    leave more than ``scan_share`` of all pairs (vectors without structure);
    rows are the same either way.  Empty tables give an empty result.
    """
    return _joined(vectors, queries, k, vec, id_col, query_id_col, query_col, options, exact, dist_col,
                   broadcast_bytes, scan_share)[0]


def pivot_search_report(vectors: DataFrame, queries: DataFrame, k: int = 10, vec="embedding", id_col="id",
                        query_id_col="query_id", query_col: str = "query", options=None, exact: bool = False,
                        broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, scan_share: float = SCAN_SHARE) -> DataFrame:
    """What the bounds saved: one row ``(queries, rows, cells, pairs, pairs_met, skipped)``.

    ``pairs`` counts queries with a bound times rows; ``skipped`` is the share of them no task met.
    """
    _, kinds, cells, rows, met = _joined(vectors, queries, k, vec, id_col, query_id_col, query_col, options, exact,
                                         "dist", broadcast_bytes, scan_share)
    asked = kinds.agg(F.count(F.lit(1)).alias("queries"), F.count(F.when(F.col("__n") >= 0, 1)).alias("bounded"))
    n = F.lit(int(rows))
    pairs = F.col("bounded") * n
    return asked.crossJoin(cells.agg(F.count(F.lit(1)).alias("cells"))).select(
        "queries", n.cast("long").alias("rows"), "cells", pairs.alias("pairs"), F.lit(int(met)).cast("long").alias("pairs_met"),
        F.when(pairs > 0, 1.0 - F.lit(float(met)) / pairs).alias("skipped"))


__all__ = ["pivot_search_many", "pivot_search_report", "fit_pivots"]
