"""Jaccard join, line dedup, substring dedup, mixing, sharding against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from quiver.llm import components, jaccard, linededup, mixing, queries, sharding, substrings
from quiver.llm.hashing import by_bytes, window_hashes, word_hashes

from . import brute

SF = "/root/testdata/sf0.001"


def _multiset(rows):
    return Counter(tuple(r) for r in rows)


def test_word_hashes_agree_with_words():
    texts = ["a b  a", None, "", " Ab\tb\x0bb c ", "x" * 100, "a b c d e f g h"]
    hashes, counts = word_hashes(pa.array(texts))
    flat = [w for t in texts for w in brute.words(t)]
    assert counts.tolist() == [len(brute.words(t)) for t in texts]
    assert len({(h, w) for h, w in zip(hashes.tolist(), flat)}) == len(set(flat)) == len(set(hashes.tolist()))
    lower, _ = word_hashes(pa.array(["AB É"]), lower=True)
    assert lower.tolist() == word_hashes(pa.array(["ab É"]))[0].tolist()
    for width in (1, 2, 5, 15, 35):
        w = np.array([1, 2, 3, 4] * 30, dtype=np.uint64)
        got = window_hashes(w, width)[:len(w) - width + 1]
        assert len(set(got.tolist())) == 4 and (got[0] == got[4])


def test_long_texts_are_cut_at_white_space(monkeypatch):
    from quiver.llm import hashing

    text = " ".join(f"w{i}" for i in range(2000))
    whole = word_hashes(pa.array([text, "b"]))
    monkeypatch.setattr(hashing, "SLICE", 64)
    assert [x.tolist() for x in word_hashes(pa.array([text, "b"]))] == [x.tolist() for x in whole]
    batch = pa.record_batch([pa.array(["aaaa", "bb", None, "c" * 50, "d"])], names=["t"])
    assert sum(p.num_rows for p in by_bytes(batch, 0, 6)) == 5


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (205, 203), (203, 204)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = {i: 0 for i in range(41)} | {k: 100 for k in range(100, 130)} | {203: 203, 204: 203, 205: 203}
    assert got == want
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("block, listed", [(512, 128), (6, 3)])
def test_jaccard_components(clashing, corpus, monkeypatch, block, listed):
    # small limits send the same corpus through cut groups and block pairs
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "LISTED", listed)
    sets, want = brute.components([(r[0], r[1]) for r in corpus])
    got = jaccard.link_documents(clashing).select("doc_id", "n_shingles", "component_id").collect()
    assert _multiset(got) == Counter((r[0], len(sets[i]), want[i]) for i, r in enumerate(corpus))


def test_jaccard_settles_without_contraction(docs, corpus, monkeypatch):
    """The prefix step alone finds every link."""
    monkeypatch.setattr(jaccard, "_contract", lambda sets, percent: sets.sparkSession.createDataFrame(
        [], "u long, v long"))
    sets, want = brute.components([(r[0], r[1]) for r in corpus])
    got = jaccard.link_documents(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert _multiset(got) == Counter((r[0], len(sets[i]), want[i]) for i, r in enumerate(corpus))


def test_equal_sets_in_another_order_link_alike(spark):
    """Shared shingles are found in any text of a class, whichever row of it comes first."""
    h, s1, s2 = "h0 h1 h2 h3", [f"a{i}" for i in range(100)], " ".join(f"b{i}" for i in range(100))
    near = list(s1)
    for i in (10, 28, 46, 64, 82):
        near[i] = f"new{i}"
    s1, near = " ".join(s1), " ".join(near)
    rows = [(2, f"{h} {s2} {h} {s1} {h}"), (1, f"{h} {s1} {h} {s2} {h}"), (3, f"{h} {near} {h} {s2} {h}")]
    sets, want = brute.components(rows)
    assert sets[0] == sets[1] and set(want.values()) == {1}
    for order in (rows, rows[::-1]):
        got = jaccard.link_documents(spark.createDataFrame(order, "doc_id long, text string").coalesce(1)).collect()
        assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 1}


def test_keep_one_of_each(clashing, corpus):
    sets, want = brute.components([(r[0], r[1]) for r in corpus])
    kept = jaccard.keep_one_of_each(clashing)
    assert kept.columns == clashing.columns
    expected = {(r[0], r[1]) for i, r in enumerate(corpus) if want[i] is None or want[i] == r[0]}
    assert {(r.doc_id, r.text) for r in kept.collect()} == expected


def test_overlaps_and_forest():
    rng = np.random.default_rng(1)
    sets = [rng.choice(300, 60, replace=False) for _ in range(20)]
    got = jaccard.overlaps(np.repeat(np.arange(20), 60), np.concatenate(sets), 20)
    for i in range(20):
        for j in range(20):
            assert i == j or got[i, j] == len(set(sets[i]) & set(sets[j]))


def test_lines(clashing, corpus):
    out = linededup.dedup_lines(clashing, 5)
    assert out.columns == [c for c in clashing.columns if c not in ("n_lines", "n_removed")] + ["n_lines", "n_removed"]
    got = _multiset((r.doc_id, r.n_lines, r.n_removed, r.text) for r in out.collect())
    want = Counter((c[0], *b) for c, b in zip(corpus, brute.cut_lines([(r[0], r[3], r[1]) for r in corpus], 5)))
    assert got == want and any(r[2] for r in got)


def test_lines_near_the_threshold_are_counted_exactly(spark):
    rows = [(i * 100 + s, f"line {i}\nown {i} {s}", f"site{s}") for i in range(60) for s in range(i + 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.n_removed for r in linededup.dedup_lines(docs, 30).collect()}
    assert got == {d: int(d // 100 + 1 >= 30 and d % 100 > 0) for d, _, _ in rows}


def test_cleaned_documents_keep_columns_of_any_name(clashing):
    out = linededup.cleaned_documents(clashing, 5)
    assert out.columns == clashing.columns
    same = clashing.select("n_lines", "v").distinct().collect()
    assert out.select("n_lines", "v").distinct().collect() == same


def test_cleaned_documents_count_characters(docs):
    for r in linededup.cleaned_documents(docs, 5).filter("text IS NOT NULL").collect():
        assert r.n_chars in (len(r.text), 1)


def test_substrings(clashing, corpus):
    got = substrings.remove_repeats(clashing, 35).collect()
    want = Counter((c[0], *b) for c, b in zip(corpus, brute.without_repeats([r[1] for r in corpus])))
    assert _multiset(got) == want
    sha = substrings.remove_repeats(clashing, 35, texts=False).collect()
    assert _multiset(sha) == Counter({(d, n, m, hashlib.sha256(k.encode()).hexdigest()): c
                                      for (d, n, m, k), c in want.items()})
    with pytest.raises(ValueError):
        substrings.remove_repeats(clashing, 20)


def test_cover_has_every_difference():
    cover = substrings.COVER
    assert {(a - b) % substrings.PERIOD for a in cover for b in cover} == set(range(substrings.PERIOD))


def test_mix_takes_the_targets(clashing, corpus):
    rows = mixing.mix_sources(clashing).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter(
        (r[0], r[3], len(brute.words(r[1]))) for r in corpus)
    taken, sizes = Counter(), Counter()
    for r in rows:
        taken[r.source] += r.taken
        sizes[r.source] += r.size
        assert 0 <= r.taken <= 3 * r.size
    targets = {r.source: r.target for r in rows}
    assert all(abs(taken[s] - targets[s]) <= 0.5 for s in targets)
    assert abs(sum(targets.values()) - sum(sizes.values())) < 1e-6
    weights = {s: k % 3 + 1 for k, s in enumerate(sorted((s for s in sizes if s), key=str) + [None])}
    free = {targets[s] / weights[s] for s in sizes if targets[s] < 3 * sizes[s] - 1e-9}
    assert max(free) - min(free) < 1e-6
    again = mixing.mix_sources(clashing.repartition(3)).collect()
    assert _multiset(again) == _multiset(rows)


def test_capped_targets(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 0), (None, 100)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got == {"a": 780.0, "b": 30.0, "c": 0.0, None: 300.0}


def test_mixed_documents_repeat_and_cut(clashing, corpus):
    taken = defaultdict(int)
    for r in mixing.mix_sources(clashing).collect():
        taken[r.doc_id, r.source, r.size] += r.taken
    mixed = mixing.mixed_documents(clashing)
    assert mixed.columns == clashing.columns
    got, whole = defaultdict(int), defaultdict(list)
    for r in corpus:
        whole[r[0], r[3]].append(r[1])
    for r in mixed.collect():
        source = [t for t in whole[r.doc_id, r.source] if t and t.startswith(r.text)]
        assert source
        got[r.doc_id, r.source, len(brute.words(source[0]))] += len(brute.words(r.text))
    assert got == {k: v for k, v in taken.items() if v}


def test_shards(clashing, corpus):
    for shards in (1, 7):
        rows = sharding.shard_rows(clashing, shards).collect()
        assert Counter((r.doc_id, r.text) for r in rows) == Counter((r[0], r[1]) for r in corpus)
        slots = defaultdict(list)
        for r in rows:
            slots[r.shard].append(r.slot)
        sizes = [len(slots[s]) for s in range(shards)]
        assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    digest = sharding.shard_documents(clashing).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in digest) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in corpus)
    assert {r.law for r in digest} == {"rows"} and {r.grown_shard for r in digest} == {None}


def test_shards_of_maps_and_quoted_names(spark):
    rows = spark.range(40).selectExpr("id AS doc_id", "map('k', id) AS m", "id AS `a``b`", "struct(map(id, 1) AS x) AS s")
    got = sharding.shard_rows(rows, 3)
    assert got.columns == ["doc_id", "m", "a`b", "s", "shard", "slot"]
    assert sorted(Counter(r.shard for r in got.collect()).values()) == [13, 13, 14]
    kept = linededup.cleaned_documents(rows.selectExpr("*", "'a line' AS text", "'src' AS source"), 2)
    assert "a`b" in kept.columns and kept.count() == 40


def test_communication_matrix_is_exact_and_uniform():
    sizes = [5, 0, 17, 300, 1]
    for seed in range(20):
        m = np.array(sharding.communication_matrix(sizes, 4, seed))
        assert m.sum(axis=1).tolist() == sizes
        assert m.sum(axis=0).tolist() == [81, 81, 81, 80]
    big = 10 ** 10
    rng = np.random.Generator(np.random.PCG64(3))
    draws = np.array([sharding.hypergeometric(rng, big // 4, big, 2000) for _ in range(3000)])
    assert abs(draws.mean() - 400) < 2 and abs(draws.std() - 17.9) < 1.0
    m = np.array(sharding.communication_matrix([big, 10, big], 3, 1), dtype=object)
    assert m.sum(axis=1).tolist() == [big, 10, big] and max(m.sum(axis=0)) - min(m.sum(axis=0)) <= 1


def test_every_shard_is_equally_likely(spark):
    counts = Counter()
    docs = spark.range(12).selectExpr("id AS doc_id").repartition(3).cache()
    for seed in range(12):
        counts.update((r.doc_id, r.shard) for r in sharding.shard_rows(docs, 3, seed).collect())
    assert all(counts[d, s] for d in range(12) for s in range(3))


def test_empty_tables(empty):
    assert jaccard.link_documents(empty).count() == 0
    assert jaccard.keep_one_of_each(empty).count() == 0
    assert linededup.dedup_lines(empty).count() == 0
    assert substrings.remove_repeats(empty).count() == 0
    assert mixing.mix_sources(empty).count() == 0
    assert mixing.mixed_documents(empty).count() == 0
    assert sharding.shard_rows(empty, 4).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracles(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(queries.ORACLE_SQL[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    got, want = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert got.equals(want)


def test_exchange_answers_are_packed_by_owner():
    from quiver.llm import exchange

    rng = np.random.default_rng(3)
    keys = rng.integers(-1 << 62, 1 << 62, 300)
    pool = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    hashed = []
    for lo in range(0, 300, 100):
        row = np.repeat(np.arange(100), 50)
        hashed.append((keys[lo:lo + 100], row, rng.choice(pool, len(row)), np.tile(np.arange(50), 100)))
    held = {}
    for k, row, hashes, place in hashed:
        for r, h, p in zip(row.tolist(), hashes.tolist(), place.tolist()):
            held.setdefault(h, set()).add((int(k[r]), p))
    for repeats in (False, True):
        want = {x for v in held.values() for x in v
                if (len(v) > 1 if repeats else len({k for k, _ in v}) > 1)}
        for buckets in (3, 200):
            packed = pa.Table.from_batches([b for h in hashed for b in exchange._pack(h, buckets, np.uint64, repeats)])
            answers = [exchange._answer(np.uint64, repeats, 24)(packed.filter(pc.equal(packed["bucket"], b)))
                       for b in sorted(set(packed["bucket"].to_pylist()))]
            # a bucket answers once per owner, however many keys it meets
            assert all(a.num_rows <= 24 and len(set(a["owner"].to_pylist())) == a.num_rows for a in answers)
            answers = pa.concat_tables(answers)
            got = set()
            for owner in set(answers["owner"].to_pylist()):
                merged = exchange._merged(answers.filter(pc.equal(answers["owner"], owner)))
                got |= {(k, p) for k, v in zip(merged["key"].to_pylist(), merged["places"].to_pylist()) for p in v}
                assert sum(map(len, merged["places"].to_pylist())) == len({(k, p) for k, v in zip(
                    merged["key"].to_pylist(), merged["places"].to_pylist()) for p in v})
            # with one batch's repeats known there and then, nothing is lost and nothing added
            assert want <= got and got <= {x for v in held.values() for x in v if len(v) > 1}
