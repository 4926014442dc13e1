"""Randomised checks of the Spark operators against brute force.

Tables mix NULL vectors, NULL elements, ragged lengths, zero vectors, NaN,
exact duplicates (ties) and a hot group holding about half the rows; each
case runs with a random partition count.
"""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quiver import radius_search, search, search_groups, search_many
from quiver.operators.setdist import min_distance_to_set

DIM = 3


def _row_vec(rng, kind):
    if kind == 0:
        return None
    if kind == 1:
        return [0.5, None, 0.1]
    if kind == 2:
        return [0.2, 0.3]
    if kind == 3:
        return [0.0, 0.0, 0.0]
    if kind == 4:
        return [float("nan"), 1.0, 0.0]
    if kind == 5:
        return [1.0, 1.0, 1.0]                       # duplicates -> ties
    return [float(x) for x in np.round(rng.normal(size=DIM), 1)]


def _table(seed, n):
    rng = np.random.default_rng(seed)
    kinds = rng.choice(12, size=n)                   # mostly ordinary vectors
    groups = np.where(rng.random(n) < 0.5, 0, rng.integers(1, 4, n))   # group 0 is hot
    ids = rng.permutation(10 * n)[:n]
    return [(int(i), _row_vec(rng, int(k)), int(g)) for i, k, g in zip(ids, kinds, groups)]


def _dist(v, q):
    if v is None or q is None or len(v) != len(q) or any(x is None for x in v) or any(
            x is None for x in q):
        return None
    na = sum(x * x for x in v)
    nb = sum(x * x for x in q)
    if na == 0 or nb == 0:
        return 1.0
    return 1.0 - sum(a * b for a, b in zip(v, q)) / (math.sqrt(na) * math.sqrt(nb))


def _key(d, i):
    # raw values: the engine reports the scalar formula's own bits (``_dist``
    # is that formula), so parallel vectors that differ in the last bit are
    # ordered by those bits, and only equal values fall back to the id
    if d is None:
        return (2, 0.0, i)
    if math.isnan(d):
        return (1, 0.0, i)
    return (0, d, i)


def _brute_topk(rows, q, k):
    return [i for _, _, i in sorted(_key(_dist(v, q), i) for i, v, _ in rows)[:k]]


def _df(spark, rows, parts):
    return spark.createDataFrame(rows, "id long, embedding array<double>, g int").repartition(parts)


SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(seed=st.integers(0, 10_000), n=st.integers(1, 60), k=st.integers(1, 8),
       parts=st.integers(1, 6))
def test_exact_top_k_random_tables(spark, seed, n, k, parts):
    rows = _table(seed, n)
    q = [0.3, -0.2, 0.9]
    got = [r["id"] for r in search(_df(spark, rows, parts), q, k, exact=True).collect()]
    assert got == _brute_topk(rows, q, k)


@SETTINGS
@given(seed=st.integers(0, 10_000), n=st.integers(1, 60), k=st.integers(1, 5),
       parts=st.integers(1, 6), salt=st.sampled_from([1, 3]))
def test_group_top_k_random_tables(spark, seed, n, k, parts, salt):
    rows = _table(seed, n)
    q = [0.3, -0.2, 0.9]
    out = search_groups(_df(spark, rows, parts), q, "g", k, exact=True, salt_buckets=salt).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r["g"], r["rank"])):
        got.setdefault(r["g"], []).append(r["id"])
    want = {}
    for g in sorted({g for _, _, g in rows}):
        want[g] = _brute_topk([r for r in rows if r[2] == g], q, k)
    assert got == want


@SETTINGS
@given(seed=st.integers(0, 10_000), n=st.integers(2, 40), parts=st.integers(1, 5),
       plan=st.sampled_from(["queries", "vectors", "blocks"]))
def test_many_queries_random_tables(spark, seed, n, parts, plan):
    rows = _table(seed, n)
    df = _df(spark, rows, parts)
    queries = spark.createDataFrame([(0, [0.3, -0.2, 0.9]), (1, [1.0, 1.0, 1.0]), (2, None),
                                     (3, [0.0, 0.0, 0.0]), (4, [1.0, 2.0])],
                                    "query_id long, query array<double>")
    budgets = {"queries": (1 << 26, None), "vectors": (1, 1 << 26), "blocks": (1, 1)}[plan]
    out = search_many(df, queries, 3, exact=True, broadcast_bytes=budgets[0],
                      vector_broadcast_bytes=budgets[1]).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["id"])
    for qid, q in [(0, [0.3, -0.2, 0.9]), (1, [1.0, 1.0, 1.0]), (2, None), (3, [0.0, 0.0, 0.0]),
                   (4, [1.0, 2.0])]:
        assert got.get(qid, []) == _brute_topk(rows, q, 3), qid


@SETTINGS
@given(seed=st.integers(0, 10_000), n=st.integers(1, 50), parts=st.integers(1, 5),
       radius=st.sampled_from([0.0, 0.5, 1.0, 1.5]))
def test_radius_random_tables(spark, seed, n, parts, radius):
    rows = _table(seed, n)
    q = [0.3, -0.2, 0.9]
    got = sorted(r["id"] for r in radius_search(_df(spark, rows, parts), q, radius, exact=True).collect())
    want = sorted(i for i, v, _ in rows
                  if (d := _dist(v, q)) is not None and not math.isnan(d) and d <= radius)
    assert got == want


@SETTINGS
@given(seed=st.integers(0, 10_000), n=st.integers(1, 40), parts=st.integers(1, 5),
       block=st.booleans())
def test_set_distance_random_tables(spark, seed, n, parts, block):
    rows = _table(seed, n)
    df = _df(spark, rows, parts)
    members = df.filter("g = 1")
    got = {r["id"]: r["min_dist"] for r in
           min_distance_to_set(df, members, broadcast_bytes=1 if block else 1 << 26).collect()}
    valid_members = [v for _, v, g in rows if g == 1 and v is not None
                     and all(x is not None for x in v)]
    for i, v, _ in rows:
        if v is None or any(x is None for x in v):
            assert got[i] is None
            continue
        if not valid_members:
            assert got[i] == 1.0
            continue
        same = [s for s in valid_members if len(s) == len(v)]
        if not same:
            assert got[i] is None
            continue
        ds = [d for s in same if (d := _dist(v, s)) is not None and not math.isnan(d)]
        assert got[i] == pytest.approx(min([1.0] + ds), abs=1e-12)
