"""Arrow scoring functions handed to ``mapInArrow``.

Each factory returns ``f(iterator[RecordBatch]) -> iterator[RecordBatch]``.
The query bank arrives as a Spark broadcast variable (size-checked by the
caller).  Top-k scorers keep a running top-k per key for the whole task and
emit it once, so a task ships ``keys * k`` rows to the shuffle whatever its
input size, and a hot group costs no more than any other.

Screen, then exact: a BLAS product ranks a whole batch fast but its last
bits depend on matrix shape and alignment, so it only *screens*.  Every
pair that could be selected (within :func:`screen_margin` of the cut) is
recomputed with the ordered formula (:func:`exact_cosine`), and selection
and output use those values.  Distances are therefore bit-identical to a
scalar ``1 - a.b / (|a| |b|)`` loop and to the Catalyst expression, and
ties (duplicate vectors) break by id, whatever the batching or partitioning.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..functions.arrays import (columns_to_matrix, cosine_to_points, doubtful, exact_cosine, list_dims,
                               list_to_matrix, screen_margin, sq_norms, unit_rows)
from ..functions.selection import NULL, TopKState, classify, keep_first_k
from ..plans.keys import LazyKeys, RowKey, as_objects, built, quoted

# cap on elements of one distance block (rows x queries) held at once
BLOCK_ELEMENTS = 1 << 22


class VectorSpec:
    """Where a row's vector lives: one array column, or numeric columns."""

    def __init__(self, vec):
        if isinstance(vec, str):
            self.array_col, self.cols = vec, None
        else:
            self.array_col, self.cols = None, list(vec)
            if not self.cols:
                raise ValueError("empty feature column list")

    @property
    def columns(self) -> list[str]:
        return [self.array_col] if self.array_col else list(self.cols)

    def select(self) -> list:
        """The vector's columns under inner names."""
        return [quoted(c).alias(a) for c, a in zip(self.columns, self.inner().columns)]

    def inner(self) -> "VectorSpec":
        return VectorSpec("__v" if self.array_col else [f"__v{i}" for i in range(len(self.cols))])

    def matrix(self, batch: pa.RecordBatch, dim: int):
        if self.array_col:
            return list_to_matrix(batch.column(self.array_col), dim)
        n = batch.num_rows
        if dim != len(self.cols):
            return np.empty((0, dim)), np.zeros(n, dtype=bool)
        return columns_to_matrix([batch.column(c) for c in self.cols])


class _Codes:
    """Partition-wide dictionary for a group column (values -> int codes)."""

    def __init__(self):
        self.index: dict = {}
        self.values: list = []

    def encode(self, arr: pa.Array) -> np.ndarray:
        if pa.types.is_nested(arr.type):
            values = arr.to_pylist()
            local = [self._code(repr(v), v) for v in values]
            return np.asarray(local, dtype=np.int64)
        enc = pc.dictionary_encode(arr, null_encoding="encode")
        local = []
        for v in enc.dictionary.to_pylist():
            local.append(self._code(v, v))
        local = np.asarray(local, dtype=np.int64)
        return local[np.asarray(enc.indices.to_numpy(zero_copy_only=False), dtype=np.int64)]

    def _code(self, key, value) -> int:
        code = self.index.get(key)
        if code is None:
            code = self.index[key] = len(self.values)
            self.values.append(value)
        return code

    def decode(self, codes: np.ndarray, typ: pa.DataType) -> pa.Array:
        return pa.array([self.values[c] for c in codes], type=typ)


def _block_rows(nv: int) -> int:
    return max(1, BLOCK_ELEMENTS // max(nv, 1))


def _owner_min(D: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Min over consecutive column runs (probes of one query)."""
    return np.minimum.reduceat(D, starts, axis=1)


def candidate_ddl(key: RowKey, query_key: RowKey | None = None, group_type: str | None = None) -> str:
    """Schema of scored rows: query position, query key, group, row key, distance."""
    parts = ["__q long", query_key.ddl if query_key else None, f"__g {group_type}" if group_type else None,
             key.ddl, "__d double"]
    return ", ".join(p for p in parts if p)


def _candidates(bank, entries: np.ndarray, key: RowKey, ids: np.ndarray, dist: pa.Array, group=None):
    """One output batch; ``entries`` are places in the bank."""
    columns = [pa.array(bank.base + entries, type=pa.int64())]
    names = ["__q"]
    for name, values in zip(bank.key_names, bank.keys):
        columns.append(values.take(pa.array(entries, pa.int64())))
        names.append(name)
    if group is not None:
        columns.append(group)
        names.append("__g")
    return pa.RecordBatch.from_arrays(columns + key.write(ids) + [dist], names=names + key.inner + ["__d"])


def topk_scorer(bank_bc, spec: VectorSpec, key: RowKey, k: int, group_type: pa.DataType | None = None,
                owners=None):
    """Running top-k per (query[, group]) for one task.

    Input columns have their inner names (``key.select()``, ``spec.select()``,
    ``__g``); ``spec`` is the inner one.  ``owners``: optional ``(owner
    entries (O,), run starts per dim group, owner index per run per dim
    group)`` when several bank entries (probes) belong to one output query and
    a row's distance to that query is the minimum over its probes.  Entries
    must then be ordered by owner within each dimension group.
    """

    def run(batches):
        bank = bank_bc.value
        out_entries = np.arange(bank.size) if owners is None else owners[0]
        state = TopKState(len(out_entries) * (16 if group_type else 1), k)
        codes = _Codes() if group_type else None
        # rows without a distance: the same k smallest keys for every query of a group
        unscored: dict[int, np.ndarray] = {}
        saw = False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            saw = True
            ids = key.read(batch)
            gcodes = codes.encode(batch.column("__g")) if group_type else None
            for gi, (dim, entries, pts, psq) in enumerate(bank.groups):
                mat, valid = spec.matrix(batch, dim)
                vidx = np.flatnonzero(valid)
                targets = entries if owners is None else owners[2][gi]
                if len(vidx):
                    vid = ids[vidx]
                    eps = screen_margin(dim)
                    if gcodes is not None:
                        _add_grouped(state, mat, pts, targets, vid, k, gcodes[vidx])
                    elif owners is None:
                        msq = sq_norms(mat)
                        units = bank.unit(gi)
                        step = _block_rows(len(vidx))
                        for lo in range(0, len(entries), step):
                            chunk = pts[lo:lo + step]
                            D = cosine_to_points(mat, chunk, msq, psq[lo:lo + step], units[lo:lo + step])
                            _add(state, D, targets[lo:lo + step], vid, k, eps,
                                 lambda r, c, chunk=chunk: exact_cosine(mat[r], chunk[c]),
                                 doubtful(msq), doubtful(psq[lo:lo + step]))
                    else:
                        starts = owners[1][gi]
                        msq = sq_norms(mat)
                        D = _owner_min(cosine_to_points(mat, pts, msq, psq), starts)
                        ends = np.append(starts[1:], len(pts))
                        _add(state, D, targets, vid, k, eps,
                             lambda r, c: _exact_owner_min(mat, pts, starts, ends, r, c),
                             doubtful(msq), np.logical_or.reduceat(doubtful(psq), starts))
                inv = np.flatnonzero(~valid)
                if len(inv) and gcodes is not None:
                    _add_nulls(state, targets, ids[inv], k, gcodes[inv])
                elif len(inv):
                    unscored[gi] = _smallest(unscored.get(gi), ids[inv], k)
            if len(bank.null_idx) and owners is None:
                if gcodes is not None:
                    _add_nulls(state, bank.null_idx, ids, k, gcodes)
                else:
                    unscored[-1] = _smallest(unscored.get(-1), ids, k)
        if not saw:
            return
        for gi, rows in unscored.items():
            targets = bank.null_idx if gi < 0 else bank.groups[gi][1] if owners is None else owners[2][gi]
            step = max(1, BLOCK_ELEMENTS // max(len(rows), 1))
            for lo in range(0, len(targets), step):
                _add_nulls(state, targets[lo:lo + step], rows, k, None)
        res = state.result()
        if res is None:
            return
        keys, cls, dist, rid = res
        step = BLOCK_ELEMENTS
        for lo in range(0, len(rid), step):
            part = slice(lo, lo + step)
            c = cls[part]
            dist_arr = pa.array(np.where(c == NULL, 0.0, np.where(c == 1, np.nan, dist[part])),
                                type=pa.float64(), mask=(c == NULL))
            yield _candidates(bank, out_entries[keys[0][part]], key, rid[part], dist_arr,
                              codes.decode(keys[1][part], group_type) if group_type else None)

    return run


def _smallest(held, ids, k: int) -> np.ndarray:
    ids = built(ids)
    if held is not None:
        if held.dtype == object or ids.dtype == object:
            held, ids = as_objects(held), as_objects(ids)
        ids = np.concatenate([held, ids])
    return np.sort(ids)[:k]


def _screen(D: np.ndarray, k: int, eps: float, thr=None, odd_rows=None, odd_columns=None):
    """(row, col) pairs that may belong to each column's exact top-k.

    The cut per column is the running exact k-th distance when the task
    already holds k numbers for it, else the screened k-th value of this
    block (a values-only partition); every row within ``eps`` of the cut
    stays.  A column whose k-th value is NaN (fewer than k numbers) keeps
    every row.  Rows and columns marked odd (their products overflow or lose
    digits) always stay and take no part in the cut.
    """
    n, Q = D.shape
    if n <= k:
        return np.nonzero(np.ones((n, Q), dtype=bool))
    cut = np.full(Q, np.nan) if thr is None else np.array(thr, dtype=np.float64)
    need = np.isnan(cut)
    odd = odd_rows is not None and odd_rows.any()
    known = D[~odd_rows] if odd else D
    if len(known) < k:
        cut[need] = np.nan
    elif need.all():
        cut = np.partition(known, k - 1, axis=0)[k - 1]
    elif need.any():
        cols = np.flatnonzero(need)
        cut[cols] = np.partition(known[:, cols], k - 1, axis=0)[k - 1]
    bound = cut + eps
    mask = D <= bound[None, :]
    if odd:
        mask[odd_rows] = True
    if odd_columns is not None and odd_columns.any():
        mask[:, odd_columns] = True
    loose = np.isnan(bound)
    if loose.any():
        mask[:, loose] = True
    return np.nonzero(mask)


def _add(state, D, targets, vid, k, eps, exact, odd_rows=None, odd_columns=None):
    targets = np.asarray(targets)
    thr = state.thresholds()
    r, c = _screen(D, k, eps, None if thr is None else thr[targets], odd_rows, odd_columns)
    if len(r) == 0:
        return
    cls, dist = classify(exact(r, c))
    state.add([targets[c]], cls, dist, built(vid[r]))


def _exact_owner_min(mat, pts, starts, ends, r, c):
    """Exact min over each owner's probes for candidate pairs (NaN propagates)."""
    out = np.empty(len(r))
    for o in np.unique(c):
        sel = np.flatnonzero(c == o)
        rows = mat[r[sel]]
        vals = np.stack([exact_cosine(rows, pts[j]) for j in range(starts[o], ends[o])])
        out[sel] = vals.min(axis=0)
    return out


def _add_grouped(state, mat, pts, targets, vid, k, gcodes):
    """Per query, exact distances for every row, then k per group."""
    for j in range(pts.shape[0]):
        cls, dist = classify(exact_cosine(mat, pts[j]))
        groups, rows = gcodes, vid
        if isinstance(vid, LazyKeys):
            # keys are built for the first k of each group and their ties only
            some = _first_with_ties(groups, cls, dist, k)
            groups, cls, dist, rows = groups[some], cls[some], dist[some], vid[some].values()
        keep = keep_first_k([groups], cls, dist, rows, k)
        state.add([np.full(len(keep), targets[j], dtype=np.int64), groups[keep]],
                  cls[keep], dist[keep], rows[keep])


def _first_with_ties(groups, cls, dist, k) -> np.ndarray:
    """Rows that are among their group's first k by distance, or tie with the k-th."""
    order = np.lexsort((dist, cls, groups))
    g, c, d = groups[order], cls[order], dist[order]
    start = np.searchsorted(g, g, side="left")
    last = np.minimum(start + k, np.searchsorted(g, g, side="right")) - 1
    return order[(c < c[last]) | ((c == c[last]) & (d <= d[last]))]


def _add_nulls(state, targets, inv_ids, k, gcodes):
    """Rows with a NULL distance for every query in ``targets``."""
    targets = np.asarray(targets, dtype=np.int64)
    inv_ids = built(inv_ids)
    if gcodes is None:
        keep = np.sort(inv_ids)[:k]
        key_cols = [np.repeat(targets, len(keep))]
    else:
        zeros = np.zeros(len(inv_ids))
        pick = keep_first_k([gcodes], zeros.astype(np.int8), zeros, inv_ids, k)
        keep = inv_ids[pick]
        key_cols = [np.repeat(targets, len(keep)), np.tile(gcodes[pick], len(targets))]
    n = len(targets) * len(keep)
    if n:
        state.add(key_cols, np.full(n, NULL, dtype=np.int8), np.zeros(n), np.tile(keep, len(targets)))


def radius_scorer(bank_bc, spec: VectorSpec, key: RowKey, radius: float):
    """Every (query, row) pair with ``dist <= radius`` (NULL and NaN never match)."""

    def run(batches):
        bank = bank_bc.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids = key.read(batch)
            for gi, (dim, entries, pts, psq) in enumerate(bank.groups):
                mat, valid = spec.matrix(batch, dim)
                vidx = np.flatnonzero(valid)
                if not len(vidx):
                    continue
                msq = sq_norms(mat)
                eps = screen_margin(dim)
                units = bank.unit(gi)
                odd = doubtful(msq)
                step = _block_rows(len(vidx))
                for lo in range(0, len(entries), step):
                    chunk = pts[lo:lo + step]
                    D = cosine_to_points(mat, chunk, msq, psq[lo:lo + step], units[lo:lo + step])
                    near = D <= radius + eps                     # screen, then exact
                    near[odd] = True
                    near[:, doubtful(psq[lo:lo + step])] = True
                    r, c = np.nonzero(near)
                    if len(r) == 0:
                        continue
                    exact = exact_cosine(mat[r], chunk[c])
                    hit = exact <= radius
                    r, c, exact = r[hit], c[hit], exact[hit]
                    if len(r):
                        yield _candidates(bank, entries[lo + c], key, built(ids[vidx[r]]),
                                          pa.array(exact, type=pa.float64()))

    return run


def set_min_scorer(bank_bc, spec: VectorSpec, first: bool, empty: bool):
    """One part of a set: lowers the running minimum of every row (V4).

    Adds ``__m`` (the minimum over the members met so far, from 1) and
    ``__s`` (whether any had the row's length); the first part starts them.
    With an ``empty`` set (no valid member in any part) every valid row is
    seen.  Zero norms give 1 for that pair; NaN pairs never lower the minimum.
    """

    def run(batches):
        bank = bank_bc.value
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            best = np.ones(n) if first else batch.column("__m").to_numpy(zero_copy_only=False).copy()
            seen = (np.zeros(n, dtype=bool) if first
                    else batch.column("__s").to_numpy(zero_copy_only=False).astype(bool))
            for gi, (dim, entries, pts, psq) in enumerate(bank.groups):
                mat, valid = spec.matrix(batch, dim)
                vidx = np.flatnonzero(valid)
                if not len(vidx):
                    continue
                seen[vidx] = True
                msq = sq_norms(mat)
                eps = screen_margin(dim)
                units = bank.unit(gi)
                odd = doubtful(msq)
                step = _block_rows(len(vidx))
                cur = np.ones(len(vidx))
                for lo in range(0, len(entries), step):
                    chunk = pts[lo:lo + step]
                    D = cosine_to_points(mat, chunk, msq, psq[lo:lo + step], units[lo:lo + step])
                    strange = doubtful(psq[lo:lo + step])
                    # screen: pairs within eps of the row's screened minimum
                    # (fmin skips NaN: a NaN pair never lowers the minimum)
                    sure = D if not strange.any() else np.where(strange[None, :], np.nan, D)
                    low = np.fmin.reduce(sure, axis=1)
                    near = D <= (np.fmin(low, cur) + eps)[:, None]
                    near[odd] = True
                    near[:, strange] = True
                    r, c = np.nonzero(near)
                    if len(r):
                        exact = exact_cosine(mat[r], chunk[c])
                        np.fmin.at(cur, r, exact)
                best[vidx] = np.minimum(best[vidx], cur)
            if empty:
                if spec.array_col:
                    seen = list_dims(batch.column(spec.array_col)) >= 0
                else:
                    seen = columns_to_matrix([batch.column(c) for c in spec.cols])[1]
            kept = [c for c in batch.schema.names if c not in ("__m", "__s")]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(best), pa.array(seen)],
                                             names=kept + ["__m", "__s"])

    return run


def point_scorer(point, spec: VectorSpec):
    """Arrow UDF body: cosine distance of each row to one fixed point."""
    p = None if point is None else np.asarray(point, dtype=np.float64)

    def score(*cols):
        n = len(cols[0])
        if p is None:
            return pa.nulls(n, type=pa.float64())
        if spec.array_col:
            mat, valid = list_to_matrix(cols[0], len(p))
        else:
            mat, valid = columns_to_matrix(list(cols))
            if len(cols) != len(p):
                valid[:] = False
                mat = mat[:0]
        out = np.zeros(n)
        if valid.any():
            out[valid] = exact_cosine(mat, p)
        return pa.array(out, type=pa.float64(), mask=~valid)

    return score


def query_side_scorer(vec_bank_bc, k: int, key: RowKey, query_key: RowKey):
    """Top-k rows per query when the *vectors* are the broadcast side.

    Input batches hold queries (key columns, ``__p``); every task sees all
    vectors, in the order of their keys, so a place in the bank breaks ties.
    Each query's top-k is complete in the task and is emitted ranked: no
    shuffle needed.
    """

    def run(batches):
        vb = vec_bank_bc.value
        places = np.arange(vb.size)
        # per dimension: the first k rows that are not comparable
        nulls = {}

        def unscored(dim):
            if dim not in nulls:
                same = np.zeros(vb.size, dtype=bool)
                for d, entries, _, _ in vb.groups:
                    if d == dim:
                        same[entries] = True
                nulls[dim] = np.flatnonzero(~same)[:k]
            return nulls[dim]

        for batch in batches:
            if batch.num_rows == 0:
                continue
            qarr = batch.column("__p")
            qdims = list_dims(qarr)
            parts = []
            for qdim in np.unique(qdims):
                qrows = np.flatnonzero(qdims == qdim)
                group = next((g for g in vb.groups if g[0] == qdim), None) if qdim >= 0 else None
                state = TopKState(len(qrows), k)
                if group is not None:
                    qmat, _ = list_to_matrix(qarr.take(pa.array(qrows)), int(qdim))
                    _, entries, pts, psq = group
                    qsq = sq_norms(qmat)
                    qunit = unit_rows(qmat, qsq)
                    step = _block_rows(len(qrows))
                    eps = screen_margin(int(qdim))
                    for lo in range(0, len(entries), step):
                        # rows = vectors, columns = queries
                        vchunk = pts[lo:lo + step]
                        D = cosine_to_points(vchunk, qmat, psq[lo:lo + step], qsq, qunit)
                        _add(state, D, np.arange(len(qrows)), entries[lo:lo + step], k, eps,
                             lambda r, c, vchunk=vchunk: exact_cosine(vchunk[r], qmat[c]),
                             doubtful(psq[lo:lo + step]), doubtful(qsq))
                rest = unscored(int(qdim)) if group is not None else places[:k]
                _add_nulls(state, np.arange(len(qrows)), rest, k, None)
                res = state.result()
                if res is not None:
                    keys, cls, dist, place = res
                    parts.append((qrows[keys[0]], place, cls, dist))
            if not parts:
                continue
            q, place, cls, dist = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((place, dist, cls, q))
            q, place, cls, dist = q[order], place[order], cls[order], dist[order]
            starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
            rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)])) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(q)) for c in query_key.inner]
                + [pa.array(rank.astype(np.int32), type=pa.int32())]
                + [a.take(pa.array(place)) for a in vb.keys]
                + [pa.array(np.where(cls == 1, np.nan, dist), type=pa.float64(), mask=(cls == NULL))],
                names=query_key.inner + ["__r"] + key.inner + ["__d"])

    return run
