"""Exact top-k, multi-index search and toxicity against brute force."""

import math
import random

import numpy as np
import pytest
import zlib
from collections import Counter

from quiver.llm import impact, multiindex, queries, toxicity

SF = "/root/testdata/sf0.001"
INF, NAN = float("inf"), float("nan")


def _vectors(n=120, dim=6, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(size=dim)]) for i in range(n)]
    rows += [(1000 + i, rows[20][1]) for i in range(40)]                       # a vector that a quarter of rows hold
    odd = [(2000, None), (2020, [1.0, None] + [0.0] * (dim - 2)), (2040, [NAN] * dim), (2060, [INF] * dim),
           (2080, [0.0] * dim), (2100, []), (None, rows[1][1]), (2120, [1.0, 2.0, 3.0]), (2140, [3.0, 2.0, 1.0])]
    return rows + odd


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(_vectors(), "vec_id long, embedding array<double>").selectExpr(
        "*", "1 AS v", "2 AS score", "3 AS cell", "4 AS query_id").repartition(4)


def _finite(v):
    return v and all(x is not None and math.isfinite(x) for x in v)


def _brute(score, usable, step, k):
    out = set()
    rows = [(i, v) for i, v in _vectors() if i is not None and usable(v)]
    for qi, q in rows:
        if qi % step == 0:
            found = sorted((-score(q, v), i) for i, v in rows if i != qi and len(v) == len(q))[:k]
            out |= {(qi, r + 1, i, -s) for r, (s, i) in enumerate(found)}
    return out


@pytest.mark.parametrize("shard_rows, levels", [(8192, 24), (16, 3)])
def test_exact_top_k(table, monkeypatch, shard_rows, levels):
    monkeypatch.setattr(impact, "LEVELS", levels)

    def score(a, b):
        return sum(math.floor(64 * x) * math.floor(64 * y) for x, y in zip(a, b))

    vectors = impact.quantised(table)
    index = impact.build_index(vectors, shard_rows)
    got = impact.search_index(index, vectors.filter("vec_id % 20 = 0"), 6, 7)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert {tuple(r) for r in got.collect()} == _brute(score, _finite, 20, 7)


def test_impact_shard_stops_on_proof():
    rng = np.random.default_rng(1)
    rows = rng.integers(-30, 30, (600, 8))
    rows[:5] = rows[7] * 2
    shard = impact.Shard.unpack(impact.Shard(np.arange(600)[::-1].copy(), rows).pack())
    for q in (rows[7], -rows[7], np.zeros(8, np.int64)):
        ids, scores = shard.best(q, 10, 3)
        exact = sorted((-int(r @ q), 599 - i) for i, r in enumerate(rows) if 599 - i != 3)[:10]
        assert list(zip((-scores).tolist(), ids.tolist())) == exact


def _top(rows, step, k):
    """Brute force in whole numbers; components and scores stop at the ends of 64 bits."""
    end = (1 << 63) - 1
    ints = {i: [min(max(math.floor(64 * x), -end - 1), end) for x in v] for i, v in rows}
    out = set()
    for qi, q in ints.items():
        if qi % step == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in ints.items() if i != qi and len(v) == len(q))
            out |= {(qi, r + 1, i, min(max(-s, -end - 1), end)) for r, (s, i) in enumerate(found[:k])}
    return out


@pytest.mark.parametrize("wide", [2.0 ** 25, 2.0 ** 40, 2.0 ** 52, 1e300])
def test_exact_top_k_of_wide_values(spark, monkeypatch, wide):
    monkeypatch.setattr(impact, "LEVELS", 5)
    rng = np.random.default_rng(int(math.log2(wide)))
    rows = [(i, [float(x) for x in rng.normal(size=4) * (wide if i % 3 else 1.0)]) for i in range(90)]
    rows += [(90 + i, [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(30)]
    rows += [(120, [wide, 1.0, 0.0, -wide]), (121, [wide, 1.0, 0.0, -wide]), (140, [wide]), (160, [-3.0]), (141, [0.5])]
    vectors = impact.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
    got = impact.search_index(impact.build_index(vectors, 40), vectors.filter("vec_id % 20 = 0"), 4, 7)
    assert {tuple(r) for r in got.collect()} == _top(rows, 20, 7)


def test_multi_index_of_mixed_lengths(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=(1, 2, 5, 6)[i % 4])]) for i in range(200)] + [(1000, [2.0] * 9)]
    vectors = multiindex.usable_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = multiindex.search_multi_index(vectors, vectors.filter("vec_id % 5 = 0"), 4, centroids=4, share=1.0)

    def cosine(a, b):
        return float(multiindex.cosines(np.array([a]), np.array([b]))[0])

    want = set()
    for qi, q in rows:
        if qi % 5 == 0:
            found = sorted((-cosine(q, v), i) for i, v in rows if i != qi and len(v) == len(q))[:4]
            want |= {(qi, r + 1, i, -s) for r, (s, i) in enumerate(found)}
    assert {tuple(r) for r in got.collect()} == want and len({w[0] for w in want}) == 40


def test_multi_index_that_visits_all_is_exact(table):
    def cosine(a, b):
        a, b = np.array([a]), np.array([b])
        return float(multiindex.cosines(a, b)[0])

    vectors = multiindex.usable_vectors(table)
    got = multiindex.search_multi_index(vectors, vectors.filter("vec_id % 20 = 0"), 5, centroids=5, share=1.0)
    want = _brute(cosine, lambda v: _finite(v) and any(v), 20, 5)
    assert {tuple(r) for r in got.collect()} == want


def test_walk_goes_by_summed_distance():
    rng = np.random.default_rng(2)
    d1, d2 = rng.random(7), rng.random(5)
    sizes = rng.integers(0, 4, 35)
    cells = multiindex.walk_cells(d1, d2, sizes, INF)
    sums = [d1[c // 5] + d2[c % 5] for c in cells]
    assert sums == sorted(sums) and sorted(cells) == np.flatnonzero(sizes).tolist()
    some = multiindex.walk_cells(d1, d2, sizes, 10)
    assert some == cells[:len(some)] and sum(sizes[some]) >= 10 > sum(sizes[some[:-1]])


def test_multi_index_recall(spark):
    got = queries.op7_nearest_neighbours(spark, SF).collect()
    data = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in data])
    rows = multiindex.unit(np.array([r.embedding for r in data]))
    hit = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        score = rows @ rows[q]
        score[q] = -2
        best = set(ids[np.argsort(-score)[:5]].tolist())
        hit += len(best & {r.vec_id for r in got if r.query_id == ids[q]})
        total += 5
    assert hit >= 0.9 * total


def test_empty_vector_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    v = impact.quantised(none)
    assert impact.search_index(impact.build_index(v), v, 3, 5).count() == 0
    v = multiindex.usable_vectors(none)
    assert multiindex.search_multi_index(v, v, 5).count() == 0


def test_block_max_index_is_exact():
    rng = np.random.default_rng(3)
    vectors = []
    for _ in range(500):
        terms = np.sort(rng.choice(30, rng.integers(1, 6), replace=False))
        w = rng.random(len(terms)) + 0.1
        vectors.append((terms, w / np.sqrt((w * w).sum())))
    vectors += [vectors[0]] * 50
    index = toxicity.BlockMaxIndex(list(range(550)), [0] * 550, vectors, 30)
    dense = np.zeros((550, 30))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for terms, w in vectors[:80]:
        near, cosine = index.nearest(terms, w, 15)
        q = np.zeros(30)
        q[terms] = w
        exact = dense @ q
        assert np.allclose(cosine, np.sort(exact)[::-1][:15], atol=1e-12)
        assert np.allclose(exact[near], cosine, atol=1e-12) and len(set(near.tolist())) == 15


def _labelled(spark, rng, n=900):
    bad = ["vile", "scummy", "grubbel", "grubben", "grubbix"]
    plain = [f"w{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        toxic = int(rng.random() < 0.25)
        for _ in range(2 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((i, " ".join(words), i))
        if i % 2 == 0:
            labels.append((i, 1, toxic))
    truth = {d[0]: int(any(b in d[1].split() for b in bad)) for d in docs}
    docs += [(5000, None, 0), (5001, "", 0), (None, docs[0][1], 0), docs[1], (5002, "vile " * 30_000, 0)]
    labels += [(0, None, None), (None, 1, 1), (7777, 1, 1), (2, 0, labels[1][2])]
    return (spark.createDataFrame(docs, "doc_id long, text string, score int"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth, docs)


def test_toxicity(spark):
    docs, labels, truth, rows = _labelled(spark, random.Random(5))
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 3 == 1]
    right = sum((by_id[d].score >= toxicity.THRESHOLD) == bool(truth[d]) for d in held)
    assert right >= 0.97 * len(held)
    assert by_id[5002].score >= 0.7 and by_id[5000].score == by_id[5001].score < 0.1
    assert by_id[5000].evidence == [] and len(by_id[5002].evidence) > 0
    evidence = {e.doc_id for r in got for e in r.evidence}
    assert not any(zlib.crc32(str(d).encode()) % 3 == 1 for d in evidence)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    gone = {(r.doc_id) for r in got if r.score >= toxicity.THRESHOLD}
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(
        r[0] or -1 for r in rows if r[0] not in gone)


def test_toxicity_of_words_that_begin_like_ordinary_ones(spark):
    """Mixed beginnings do not fill the neighbours with clean examples, in any language."""
    rng, dealt = random.Random(11), Counter()
    docs, labels = [], []
    for i in range(2400):
        lang = ("fr", "de")[i % 2]
        stem = {"fr": "reeux", "de": "schöt"}[lang]
        words = [f"{lang}{rng.randrange(400)}" for _ in range(rng.randint(5, 40))]
        toxic = int(rng.random() < 0.12)
        if toxic:
            part = lang, zlib.crc32(str(i).encode()) % 3 == 1
            words.append(f"{stem}bad{dealt[part] % 9}")
            dealt[part] += 1
        elif rng.random() < 0.1:
            words += [f"{stem}ok{rng.randrange(10 ** 6)}" for _ in range(2)]
        rng.shuffle(words)
        docs.append((i, " ".join(words), lang))
        labels.append((i, 1, toxic))
    got = {r.doc_id: r.score for r in toxicity.score_documents(
        spark.createDataFrame(docs, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    for lang in ("fr", "de"):
        held = [(got[i], y) for i, _, y in labels if docs[i][2] == lang and zlib.crc32(str(i).encode()) % 3 == 1]
        toxic = [s for s, y in held if y]
        assert sum(s >= toxicity.THRESHOLD for s in toxic) >= 0.9 * len(toxic)
        assert sum(s >= toxicity.THRESHOLD for s, y in held if not y) <= 0.02 * (len(held) - len(toxic))


def test_the_best_cut_becomes_the_threshold():
    votes, toxic = np.array([0.9, 0.5, 0.45, 0.1, 0.1]), np.array([1, 1, 1, 0, 0])
    assert abs(toxicity.best_cut(votes, toxic) - 0.275) < 1e-12
    assert toxicity.cut_of(votes, np.zeros(5, int)) == toxicity.cut_of(votes, np.ones(5, int)) == toxicity.THRESHOLD
    assert toxicity.cut_of(votes, toxic) == toxicity.best_cut(votes, toxic)
    for cut in (0.2, 0.7, 0.95, 1.0):
        scale = [toxicity.calibrated(v, cut) for v in (0.0, cut / 2, cut, 1.0)]
        assert scale == sorted(scale) and scale[0] == 0
        assert cut == 1.0 or abs(scale[2] - toxicity.THRESHOLD) < 1e-9


def test_toxicity_without_labels_or_documents(spark):
    docs, labels, _, rows = _labelled(spark, random.Random(5), 20)
    none = labels.limit(0)
    assert {r.score for r in toxicity.score_documents(docs, none).collect()} == {0.0}
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0
    assert toxicity.drop_toxic(docs, none).count() == len(rows)


def test_held_out_rows(spark):
    rows = queries.op6_toxicity(spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def toxicity_by_hand(docs, labels, folds):
    """Scores by counting, dense vectors and a full sort: ``docs`` (id, text), ``labels`` {id: 0 or 1}."""
    def terms(text):
        out = Counter()
        for w in toxicity.WORD.findall((text or "").lower()):
            out.update([w] + [w[:n] + "*" for n in toxicity.BEGINNINGS if len(w) > n])
        return out

    bags = [terms(t) for _, t in docs]
    train = [(i, labels[d]) for i, (d, _) in enumerate(docs) if d in labels and zlib.crc32(str(d).encode()) % 3 != 1]

    def vocabulary(rows):
        n1, n = sum(y for _, y in rows), len(rows)
        have, bad = Counter(), Counter()
        for i, y in rows:
            have.update(bags[i].keys())
            bad.update(bags[i].keys() if y else ())
        everywhere = Counter()
        for i, _ in train:
            everywhere.update(bags[i].keys())

        def fits(t):
            m, a = have[t], bad[t]
            if everywhere[t] < toxicity.SUPPORT or m < toxicity.SUPPORT or a < toxicity.PURITY * m or m >= n:
                return False
            b, n0 = m - a, n - n1
            return n * (a * (n0 - b) - b * (n1 - a)) ** 2 / (m * (n - m) * max(n1, 1) * max(n0, 1)) >= toxicity.CHI

        chosen = [t for t in have if fits(t)]
        whole = [t for t in chosen if not t.endswith("*")]
        share = sum(bad[t] for t in whole) / sum(have[t] for t in whole) if whole else toxicity.PURITY
        return sorted(t for t in chosen if not t.endswith("*") or bad[t] >= share * have[t])

    everywhere = Counter(t for b in bags for t in b)

    def vectors(words):
        idf = [np.log((1 + len(docs)) / (1 + everywhere[t])) + 1 for t in words]
        x = np.array([[(1 + np.log(b[t])) * w if b[t] else 0.0 for t, w in zip(words, idf)] for b in bags]).reshape(len(docs), -1)
        return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)

    def votes(rows, of):
        x, y = vectors(vocabulary(rows)), np.array([y for _, y in rows], float)
        at = [i for i, _ in rows]
        bare = [v for i, v in rows if not x[i].any()]
        base = (sum(bare) + 0.01) / (len(bare) + 1)
        out = []
        for i in of:
            cosine = x[at] @ x[i]
            near = np.argsort(-cosine, kind="stable")[:toxicity.NEIGHBOURS]
            near = near[cosine[near] > 0]
            out.append(((cosine[near] * y[near]).sum() + toxicity.SHRINK * base) / (cosine[near].sum() + toxicity.SHRINK))
        return out

    held = {}
    for f in range(toxicity.FOLDS):
        of = [i for i, _ in train if folds[docs[i][1]] == f]
        held.update(zip(of, votes([r for r in train if folds[docs[r[0]][1]] != f], of)))
    cut = toxicity.cut_of(np.array([held[i] for i, _ in train]), np.array([y for _, y in train]))
    return {docs[i][0]: toxicity.calibrated(v, cut) for i, v in enumerate(votes(train, range(len(docs))))}


def test_toxicity_equals_brute_force(spark):
    rng = random.Random(9)
    docs, labels = [], {}
    for i in range(700):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randint(3, 30))] + [f"only{i}"]
        if rng.random() < 0.25:
            labels[i] = 1
            words += [rng.choice(["vile", "grubbel", "grubben", "scum", "muckworm"]) for _ in range(rng.randint(1, 4))]
        elif rng.random() < 0.8:
            labels[i] = 0
        docs.append((i, " ".join(words)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    folds = {r.text: r.f for r in table.selectExpr("text", f"CAST(pmod(xxhash64(text), {toxicity.FOLDS}) AS INT) AS f").collect()}
    want = toxicity_by_hand(docs, labels, folds)
    known = spark.createDataFrame([(d, 0, y) for d, y in labels.items()], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_documents(table, known).collect()}
    # equal cosines at the last place may be told apart otherwise
    close = [abs(got[d] - want[d]) < 1e-6 for d in want]
    assert got.keys() == want.keys() and np.mean(close) >= 0.97
    assert all((got[d] >= 0.7) == (want[d] >= 0.7) for d in want)


def test_scores_come_from_texts_alone(spark):
    from pyspark.sql import functions as F

    docs, labels, *_ = _labelled(spark, random.Random(5))
    plain = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    before = {r.doc_id: r.score for r in toxicity.score_documents(plain, labels).collect()}
    tagged = plain.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "de").otherwise("en")) \
        .withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 7)).repartition(7)
    assert {r.doc_id: r.score for r in toxicity.score_documents(tagged, labels).collect()} == before
    # other ids for rows that are no examples
    examples = [r.doc_id for r in labels.collect()]
    moved = plain.withColumn("doc_id", F.when(F.col("doc_id").isin([e for e in examples if e is not None]), F.col("doc_id"))
                             .otherwise(F.col("doc_id") + 3_000_000))
    after = {r.doc_id: r.score for r in toxicity.score_documents(moved, labels).collect()}
    assert all(before[d if d < 3_000_000 else d - 3_000_000] == s for d, s in after.items())


def test_impact_index_adds_dimensions_with_most_postings_as_a_whole(monkeypatch):
    rng = np.random.default_rng(5)
    rows = np.rint(rng.normal(0, 8, (2000, 64))).astype(np.int64)
    shard = impact.Shard(np.arange(2000), rows)
    single, plain = [], np.bincount

    def counted(x, weights=None, minlength=0):
        if minlength == 2000:
            single.append(len(x))
        return plain(x, weights, minlength)

    monkeypatch.setattr(impact.np, "bincount", counted)
    for i in range(0, 2000, 100):
        ids, scores = shard.best(rows[i], 20, i)
        want = sorted((-int(s), j) for j, s in enumerate(rows @ rows[i]) if j != i)[:20]
        assert [(-s, j) for j, s in zip(ids.tolist(), scores.tolist())] == want
    # posting by posting for the rest only (more than half of all before)
    assert sum(single) < 0.25 * 20 * rows.size
