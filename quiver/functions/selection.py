"""Exact partial top-k selection used inside scoring tasks.

Order everywhere is Spark's ``dist ASC NULLS LAST, id ASC``: numbers
first, then NaN (Spark sorts NaN above +Inf), then NULL.  Ties on the
distance are broken by id, so a partial top-k taken per batch or per
partition always contains the global top-k rows of that slice, whatever
the batch boundaries are.

Candidates travel as parallel arrays: one or more int64 key arrays (query
index, group code), ``cls`` (0 number, 1 NaN, 2 NULL), ``dist`` (float64,
0 where cls != 0) and ``ids`` (int64, or objects that compare as Spark orders them).
"""

from __future__ import annotations

import numpy as np

from ..plans.keys import as_objects

NUMBER, NAN, NULL = 0, 1, 2

# smallest candidate buffer before a running top-k reduces itself
MIN_BUFFER = 4096


def classify(dist: np.ndarray):
    """Split raw distances into (cls, filled dist)."""
    nan = np.isnan(dist)
    cls = nan.astype(np.int8)
    return cls, np.where(nan, 0.0, dist)


def keep_first_k(keys: list[np.ndarray], cls, dist, ids, k: int) -> np.ndarray:
    """Indices of the first ``k`` rows of every key group, in order."""
    n = len(ids)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    if ids.dtype == object:
        ids = np.unique(ids, return_inverse=True)[1]
    sort_keys = [ids, dist, cls] + list(reversed(keys))
    order = np.lexsort(sort_keys)
    if not keys:
        return order[:k]
    sk = [key[order] for key in keys]
    change = np.zeros(n, dtype=bool)
    change[0] = True
    for key in sk:
        change[1:] |= key[1:] != key[:-1]
    starts = np.flatnonzero(change)
    group_len = np.diff(np.append(starts, n))
    rank = np.arange(n) - np.repeat(starts, group_len)
    return order[rank < k]


class TopKState:
    """Running top-k per key over many batches of one task.

    Memory stays O(keys * k): candidates are reduced whenever the buffer
    has doubled since the last reduction.
    """

    def __init__(self, n_keys: int, k: int):
        self.k = k
        self.n_keys = n_keys
        self.limit = max(4 * k * max(n_keys, 1), MIN_BUFFER)
        self._parts: list[tuple] = []
        self._size = 0
        self._thr = None

    def thresholds(self):
        """Per key (single-key states): the k-th best numeric distance kept
        at the last reduction, NaN while fewer than k numbers are kept.

        A later row can only enter a key's top-k if its distance is <= this
        value, so callers may drop the rest before adding (ties are kept).
        """
        return self._thr

    def add(self, keys: list[np.ndarray], cls, dist, ids):
        if len(ids) == 0:
            return
        self._parts.append((keys, cls, dist, ids))
        self._size += len(ids)
        if self._size > self.limit:
            self._reduce()

    def _concat(self):
        if not self._parts:
            return None
        nk = len(self._parts[0][0])
        keys = [np.concatenate([p[0][j] for p in self._parts]) for j in range(nk)]
        cls = np.concatenate([p[1] for p in self._parts])
        dist = np.concatenate([p[2] for p in self._parts])
        parts = [p[3] for p in self._parts]
        if any(p.dtype == object for p in parts):
            parts = [as_objects(p) for p in parts]
        ids = np.concatenate(parts)
        return keys, cls, dist, ids

    def _reduce(self):
        cat = self._concat()
        if cat is None:
            return
        keys, cls, dist, ids = cat
        keep = keep_first_k(keys, cls, dist, ids, self.k)
        self._parts = [([key[keep] for key in keys], cls[keep], dist[keep], ids[keep])]
        self._size = len(keep)
        # as many rows again before the next reduction: its cost stays a
        # constant per row added, however many keys the state holds
        self.limit = max(self.limit, 2 * self._size)
        if len(keys) == 1 and self.n_keys:
            kk, kc, kd = keys[0][keep], cls[keep], dist[keep]
            num = kc == NUMBER
            counts = np.bincount(kk[num], minlength=self.n_keys)
            thr = np.full(self.n_keys, -np.inf)
            np.maximum.at(thr, kk[num], kd[num])
            thr[counts < self.k] = np.nan
            self._thr = thr

    def result(self):
        self._reduce()
        if not self._parts:
            return None
        return self._parts[0]
