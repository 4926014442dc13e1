"""NumPy kernels over Arrow batches.

These run inside Spark tasks (``mapInArrow`` / ``arrow_udf`` /
``applyInArrow``); Spark partitions and shuffles the work, the kernels only
turn one Arrow batch into matrices and score it.

Validity rules (a row vector gets a NULL distance when any holds):
  * the vector is NULL,
  * it contains a NULL element,
  * its length differs from the query's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _list_parts(arr: pa.Array):
    """Return (offsets int64 (n+1,), child values, row-null mask (n,))."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    if pa.types.is_fixed_size_list(arr.type):
        width = arr.type.list_size
        start = arr.offset * width
        offsets = start + np.arange(n + 1, dtype=np.int64) * width
        values = arr.values
    else:
        offsets = np.asarray(arr.offsets.to_numpy(zero_copy_only=False), dtype=np.int64)
        values = arr.values
    row_null = np.asarray(arr.is_null().to_numpy(zero_copy_only=False), dtype=bool)
    return offsets, values, row_null


def list_to_matrix(arr: pa.Array, dim: int):
    """Gather rows of a list<float|double> array that have length ``dim``.

    Returns ``(matrix, valid)``: ``matrix`` is float64 of shape
    ``(valid.sum(), dim)`` holding the valid rows in order, ``valid`` is a
    bool mask over all rows.
    """
    n = len(arr)
    if n == 0:
        return np.empty((0, dim)), np.zeros(0, dtype=bool)
    offsets, values, row_null = _list_parts(arr)
    lengths = np.diff(offsets)
    valid = (~row_null) & (lengths == dim)
    if values.null_count:
        nulls = np.asarray(values.is_null().to_numpy(zero_copy_only=False), dtype=np.int64)
        csum = np.concatenate(([0], np.cumsum(nulls)))
        valid &= (csum[offsets[1:]] - csum[offsets[:-1]]) == 0
        values = pc.fill_null(values, 0)
    flat = values.to_numpy(zero_copy_only=False)
    nvalid = int(valid.sum())
    if nvalid == 0:
        return np.empty((0, dim)), valid
    start = offsets[0]
    if nvalid == n and offsets[-1] - start == n * dim:
        # contiguous, all rows well formed: a view, then one widening copy
        mat = flat[start:start + n * dim].reshape(n, dim)
    else:
        idx = offsets[:-1][valid][:, None] + np.arange(dim, dtype=np.int64)[None, :]
        mat = flat[idx]
    return np.asarray(mat, dtype=np.float64), valid


def list_dims(arr: pa.Array):
    """Per-row length of a list array; -1 for NULL rows or rows with NULL elements."""
    offsets, values, row_null = _list_parts(arr)
    dims = np.diff(offsets)
    bad = row_null.copy()
    if values.null_count:
        nulls = np.asarray(values.is_null().to_numpy(zero_copy_only=False), dtype=np.int64)
        csum = np.concatenate(([0], np.cumsum(nulls)))
        bad |= (csum[offsets[1:]] - csum[offsets[:-1]]) > 0
    return np.where(bad, -1, dims)


def columns_to_matrix(cols: list[pa.Array]):
    """Stack numeric columns into an (n_valid, d) float64 matrix.

    A NULL in any column makes the row invalid (it is the vector
    ``array(c1, .., cd)`` with a NULL element).
    """
    n = len(cols[0])
    valid = np.ones(n, dtype=bool)
    parts = []
    for c in cols:
        if isinstance(c, pa.ChunkedArray):
            c = c.combine_chunks()
        if c.null_count:
            valid &= ~np.asarray(c.is_null().to_numpy(zero_copy_only=False), dtype=bool)
            c = pc.fill_null(c, 0)
        parts.append(np.asarray(c.to_numpy(zero_copy_only=False), dtype=np.float64))
    mat = np.column_stack(parts) if parts else np.empty((n, 0))
    return mat[valid] if not valid.all() else mat, valid


def sq_norms(mat: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", mat, mat)


def unit_rows(mat: np.ndarray, sq: np.ndarray | None = None) -> np.ndarray:
    """Rows scaled to unit length; zero rows stay zero, NaN propagates."""
    if sq is None:
        sq = sq_norms(mat)
    norm = np.sqrt(sq)
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.where(norm == 0, 0.0, 1.0 / norm)
    return mat * scale[:, None]


def cosine_to_points(mat: np.ndarray, points: np.ndarray,
                     mat_sq: np.ndarray | None = None,
                     pts_sq: np.ndarray | None = None,
                     pts_unit: np.ndarray | None = None) -> np.ndarray:
    """Screening distances of every row of ``mat`` (n, d) to every point (q, d).

    ``1 - unit(a) . unit(b)`` with one matrix product: a zero vector is a
    zero unit row, so its distance is exactly 1.0, and NaN/Inf propagate.
    The last bits depend on BLAS, shape and alignment, so these values only
    pick candidates (within :func:`screen_margin`); reported distances come
    from :func:`exact_cosine`.  Returns (n, q) in column-major order, each
    query's distances contiguous.
    """
    if mat_sq is None:
        mat_sq = sq_norms(mat)
    if pts_sq is None:
        pts_sq = sq_norms(points)
    if pts_unit is None:
        pts_unit = unit_rows(points, pts_sq)
    out = (pts_unit @ unit_rows(mat, mat_sq).T).T           # (n, q), Fortran order
    np.subtract(1.0, out, out=out)
    # the zero-norm rule comes first in the exact formula, even against NaN
    # (whether a sum of squares is zero does not depend on summation order)
    zr = mat_sq == 0
    if zr.any():
        out[zr, :] = 1.0
    zc = pts_sq == 0
    if zc.any():
        out[:, zc] = 1.0
    return out


def ordered_dot(A: np.ndarray, B: np.ndarray) -> np.ndarray:
    """Row-wise dot products summed left to right over the dimension.

    One rounding per product and one per addition, in index order: the
    value a scalar loop ``for j: acc += a[j] * b[j]`` produces, whatever the
    batch, alignment, BLAS or machine.  ``B`` may be a single point (d,).
    """
    m, d = A.shape
    if d == 0:
        return np.zeros(m)
    At = np.ascontiguousarray(A.T)
    if B.ndim == 1:
        acc = At[0] * B[0]
        tmp = np.empty(m)
        for j in range(1, d):
            np.multiply(At[j], B[j], out=tmp)
            acc += tmp
        return acc
    Bt = At if B is A else np.ascontiguousarray(B.T)
    acc = At[0] * Bt[0]
    tmp = np.empty(m)
    for j in range(1, d):
        np.multiply(At[j], Bt[j], out=tmp)
        acc += tmp
    return acc


def _ordered_dot_and_norm(A: np.ndarray, p: np.ndarray):
    """``ordered_dot(A, p)`` and ``ordered_dot(A, A)`` sharing one pass."""
    m, d = A.shape
    if d == 0:
        return np.zeros(m), np.zeros(m)
    At = np.ascontiguousarray(A.T)
    dot = At[0] * p[0]
    sq = At[0] * At[0]
    tmp = np.empty(m)
    for j in range(1, d):
        row = At[j]
        np.multiply(row, p[j], out=tmp)
        dot += tmp
        np.multiply(row, row, out=tmp)
        sq += tmp
    return dot, sq


def ordered_sq_norm(v: np.ndarray) -> float:
    """|v|^2 summed left to right (the point side of :func:`ordered_dot`)."""
    acc = 0.0
    for x in np.asarray(v, dtype=np.float64).tolist():
        acc += x * x
    return acc


def exact_cosine(A: np.ndarray, B: np.ndarray, a_sq: np.ndarray | None = None,
                 b_sq=None) -> np.ndarray:
    """Cosine distance of row pairs (or rows against one point ``B`` (d,)),
    bit-identical to ``1 - dot / (sqrt(|a|^2) * sqrt(|b|^2))`` computed by a
    scalar left-to-right loop; 1.0 when either norm is zero."""
    if a_sq is None and B.ndim == 1:
        dot, a_sq = _ordered_dot_and_norm(A, B)
    else:
        dot = ordered_dot(A, B)
        if a_sq is None:
            a_sq = ordered_dot(A, A)
    if b_sq is None:
        b_sq = ordered_sq_norm(B) if B.ndim == 1 else ordered_dot(B, B)
    with np.errstate(divide="ignore", invalid="ignore"):
        out = 1.0 - dot / (np.sqrt(a_sq) * np.sqrt(b_sq))
    zero = (a_sq == 0) | (np.asarray(b_sq) == 0)
    if np.any(zero):
        out = np.where(zero, 1.0, out)
    return out


def screen_margin(dim: int) -> float:
    """Bound on |screening distance - ordered cosine distance|.

    Each is within a few (d + 4) unit roundoffs of the true value (dot
    product, norms and normalisation, with |a.b| <= |a||b|); the margin
    takes four times the sum, so it is far above any real deviation and
    still around 1e-13 for d = 64.
    """
    return (8 * dim + 32) * 2.0 ** -52


# squared norms outside these bounds: products may overflow or lose digits,
# and the screen's error bound does not hold
SMALLEST_NORM, LARGEST_NORM = 1e-290, 1e290


def doubtful(sq: np.ndarray) -> np.ndarray:
    """Rows whose screened distances say nothing (zero norms are exact)."""
    return ~((sq == 0) | ((sq >= SMALLEST_NORM) & (sq <= LARGEST_NORM)))
