"""JVM-side vector expressions (stay inside whole-stage codegen).

These are plain Catalyst expressions built from ``aggregate`` /
``zip_with`` / ``exists``; they are what filters and SQL see.  Bulk scoring
uses the Arrow kernels instead (faster for wide vectors), with identical
value rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_vector(c) -> Column:
    """Cast any numeric array to array<double> (exact for float input)."""
    return _col(c).cast("array<double>")


def feature_vector(*cols) -> Column:
    """array<double> from numeric columns: ``array(c1, ..., cd)``."""
    return F.array(*[_col(c).cast("double") for c in cols])


def has_null_element(v) -> Column:
    return F.exists(_col(v), lambda x: x.isNull())


def valid_vector(v, dim=None) -> Column:
    """TRUE when ``v`` is non-NULL, has no NULL element and (if given) length ``dim``.

    ``dim`` may be an int or a Column (e.g. ``size(query)``).
    """
    v = _col(v)
    cond = v.isNotNull() & ~F.coalesce(has_null_element(v), F.lit(False))
    if dim is not None:
        d = F.lit(dim) if isinstance(dim, int) else _col(dim)
        cond = cond & (F.size(v) == d)
    return cond


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(as_vector(a), as_vector(b), lambda x, y: x * y),
                       F.lit(0.0), lambda acc, x: acc + x)


def sq_norm(a) -> Column:
    return F.aggregate(as_vector(a), F.lit(0.0), lambda acc, x: acc + x * x)


def cosine_distance(a, b) -> Column:
    """``1 - a.b / (|a| |b|)`` with the engine's rules.

    NULL when either side is NULL, has a NULL element, or the lengths
    differ; 1.0 when either norm is zero; NaN/Inf propagate.  Sums run in
    index order, one pass, like a scalar loop.
    """
    a, b = as_vector(a), as_vector(b)
    ok = valid_vector(a) & valid_vector(b) & (F.size(a) == F.size(b))
    na, nb = sq_norm(a), sq_norm(b)
    zero = (na == 0) | (nb == 0)
    # the division is only reached when both norms are non-zero (ANSI-safe)
    value = F.lit(1.0) - dot(a, b) / (F.sqrt(na) * F.sqrt(nb))
    return F.when(~ok, F.lit(None).cast("double")).when(zero, F.lit(1.0)).otherwise(value)


def cosine_distance_sql(a: str, b: str) -> str:
    """The same rule as a SQL expression string over two array<double> args."""
    ok = (f"({a} IS NOT NULL AND {b} IS NOT NULL AND NOT exists({a}, x -> x IS NULL) "
          f"AND NOT exists({b}, x -> x IS NULL) AND size({a}) = size({b}))")
    na = f"aggregate({a}, 0D, (s, x) -> s + x * x)"
    nb = f"aggregate({b}, 0D, (s, x) -> s + x * x)"
    dt = f"aggregate(zip_with({a}, {b}, (x, y) -> x * y), 0D, (s, x) -> s + x)"
    return (f"CASE WHEN NOT {ok} THEN CAST(NULL AS DOUBLE) "
            f"WHEN {na} = 0 OR {nb} = 0 THEN 1.0D "
            f"ELSE 1.0D - {dt} / (sqrt({na}) * sqrt({nb})) END")


def is_finite(c) -> Column:
    """No ``isfinite`` in Spark SQL: not NaN and not +-Inf (NULL stays NULL)."""
    c = _col(c)
    return ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
