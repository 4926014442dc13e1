"""Arrow / NumPy kernels: matrix extraction, cosine rules, exact top-k selection."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quiver.functions.arrays import (columns_to_matrix, cosine_to_points, list_dims,
                                     list_to_matrix)
from quiver.functions.selection import TopKState, classify, keep_first_k


def test_list_to_matrix_validity_rules():
    arr = pa.array([[1.0, 2.0], None, [1.0, None], [1.0], [1.0, 2.0, 3.0], [], [3.0, 4.0]],
                   type=pa.list_(pa.float32()))
    mat, valid = list_to_matrix(arr, 2)
    assert valid.tolist() == [True, False, False, False, False, False, True]
    assert mat.dtype == np.float64
    assert mat.tolist() == [[1.0, 2.0], [3.0, 4.0]]
    assert list_dims(arr).tolist() == [2, -1, -1, 1, 3, 0, 2]


def test_list_to_matrix_sliced_and_fixed_size():
    arr = pa.array([[9.0, 9.0], [1.0, 2.0], [3.0, 4.0]], type=pa.list_(pa.float64()))
    mat, valid = list_to_matrix(arr.slice(1), 2)
    assert valid.all() and mat.tolist() == [[1.0, 2.0], [3.0, 4.0]]
    fixed = pa.FixedSizeListArray.from_arrays(pa.array([1.0, 2.0, 3.0, 4.0, 5.0, 6.0]), 2)
    mat, valid = list_to_matrix(fixed.slice(1), 2)
    assert mat.tolist() == [[3.0, 4.0], [5.0, 6.0]]


def test_columns_to_matrix_null_makes_row_invalid():
    mat, valid = columns_to_matrix([pa.array([1.0, None, 3.0]), pa.array([4.0, 5.0, 6.0])])
    assert valid.tolist() == [True, False, True]
    assert mat.tolist() == [[1.0, 4.0], [3.0, 6.0]]


def test_cosine_rules():
    q = np.array([[0.6, 0.8]])
    rows = np.array([[0.6, 0.8], [0.0, 0.0], [0.3, 0.4], [6.0, 8.0], [-0.6, -0.8], [np.nan, 1.0]])
    d = cosine_to_points(rows, q)[:, 0]
    assert abs(d[0]) < 1e-12
    assert d[1] == 1.0                                     # N6 zero norm
    assert abs(d[2] - d[3]) < 1e-12                        # E6 scale-free
    assert abs(d[4] - 2.0) < 0.01                          # E7
    assert np.isnan(d[5])                                  # N9
    assert cosine_to_points(rows[:1], np.zeros((1, 2)))[0, 0] == 1.0


def _brute(D, ids, k):
    out = []
    for c in range(D.shape[1]):
        cls, dist = classify(D[:, c])
        order = np.lexsort((ids, dist, cls))[:k]
        out.append([(int(ids[i]), int(cls[i]), float(dist[i])) for i in order])
    return out


def test_keep_first_k_per_group_and_state_merge():
    rng = np.random.default_rng(3)
    n, k = 500, 4
    g = rng.integers(0, 7, n)
    d = rng.random(n).round(2)
    ids = np.arange(n, dtype=np.int64)
    cls = np.zeros(n, dtype=np.int8)
    full = keep_first_k([g], cls, d, ids, k)
    state = TopKState(7, k)
    for lo in range(0, n, 37):
        sl = slice(lo, lo + 37)
        state.add([g[sl]], cls[sl], d[sl], ids[sl])
    keys, _, _, rid = state.result()
    assert sorted(rid.tolist()) == sorted(ids[full].tolist())
    for grp in range(7):
        sel = ids[g == grp]
        order = sel[np.lexsort((sel, d[sel]))][:k]
        assert sorted(order.tolist()) == sorted(rid[keys[0] == grp].tolist())


@pytest.mark.parametrize("k", [1, 3])
def test_null_class_sorts_last(k):
    keys = [np.zeros(4, dtype=np.int64)]
    cls = np.array([2, 1, 0, 2], dtype=np.int8)
    keep = keep_first_k(keys, cls, np.zeros(4), np.array([0, 1, 2, 3]), k)
    assert keep.tolist() == [2, 1, 0][:k]


@settings(max_examples=40, deadline=None)
@given(seed=st.integers(0, 10_000), q=st.integers(1, 4), k=st.integers(1, 6),
       levels=st.integers(2, 8), nan_frac=st.floats(0, 0.2))
def test_running_top_k_with_threshold_filter(seed, q, k, levels, nan_frac):
    import quiver.functions.selection as sel
    from quiver.operators.scoring import _add

    with pytest.MonkeyPatch.context() as mp:
        mp.setattr(sel, "MIN_BUFFER", 8)
        state = sel.TopKState(q, k)          # reduces every few batches: thresholds in play
    rng = np.random.default_rng(seed)
    allD, allids = [], []
    next_id = 0
    for _ in range(25):
        n = int(rng.integers(1, 30))
        D = rng.integers(0, levels, size=(n, q)).astype(float) / levels
        D[rng.random((n, q)) < nan_frac] = np.nan
        ids = np.arange(next_id, next_id + n, dtype=np.int64)[rng.permutation(n)]
        next_id += n
        Df = np.asfortranarray(D)
        _add(state, Df, np.arange(q), ids, k, 0.0, lambda r, c, Df=Df: Df[r, c])
        allD.append(D)
        allids.append(ids)
    assert state.thresholds() is not None
    keys, cls, dist, rid = state.result()
    D = np.vstack(allD)
    ids = np.concatenate(allids)
    want = _brute(D, ids, k)
    for c in range(q):
        got = sorted(((int(i), int(cc), float(d)) for kk, cc, d, i in zip(keys[0], cls, dist, rid)
                      if kk == c), key=lambda t: (t[1], t[2], t[0]))
        assert got == want[c]


def test_screen_then_exact_is_bitwise_scalar_and_position_free():
    from quiver.functions.arrays import cosine_to_points, exact_cosine, screen_margin

    rng = np.random.default_rng(5)
    d = 64
    v = rng.normal(size=d)
    P = rng.normal(size=(7, d))
    seen = set()
    for off in range(4):
        for n in (1, 3, 17, 200):
            buf = rng.normal(size=n * d + off)
            M = buf[off:off + n * d].reshape(n, d)          # misaligned rows
            M[0] = v
            M[-1] = v
            E = np.stack([exact_cosine(M, P[j]) for j in range(7)], axis=1)
            seen.add(tuple(E[0]))
            seen.add(tuple(E[-1]))
            B = cosine_to_points(M, P)
            assert np.abs(B - E).max() <= screen_margin(d)
    assert len(seen) == 1                                    # same bits everywhere

    def scalar(a, b):
        dot = na = nb = 0.0
        for x, y in zip(a.tolist(), b.tolist()):
            dot += x * y
            na += x * x
            nb += y * y
        return 1.0 if na == 0 or nb == 0 else 1.0 - dot / (na ** 0.5 * nb ** 0.5)

    assert list(seen)[0] == tuple(scalar(v, P[j]) for j in range(7))


def test_state_cost_per_row_stays_flat():
    """Reductions come at doubling sizes: their number grows with the logarithm of the state."""
    from quiver.functions.selection import TopKState

    state, reductions = TopKState(16, 10), 0
    plain = state._reduce

    def counted():
        nonlocal reductions
        reductions += 1
        plain()

    state._reduce = counted
    rng = np.random.default_rng(0)
    for _ in range(60):
        n = 10_000
        state.add([np.zeros(n, dtype=np.int64), rng.integers(0, 100_000, n)], np.zeros(n, dtype=np.int8),
                  rng.random(n), rng.integers(0, 1 << 40, n))
    assert reductions <= 12


def test_keys_of_any_type_sort_as_spark_sorts():
    from quiver.functions.selection import keep_first_k

    ids = np.empty(4, dtype=object)
    ids[:] = [((True, "b"),), ((False, None),), ((True, "a"),), ((True, "B"),)]
    keep = keep_first_k([np.zeros(4, dtype=np.int64)], np.zeros(4, dtype=np.int8), np.zeros(4), ids, 4)
    assert keep.tolist() == [1, 3, 2, 0]
