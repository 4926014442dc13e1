"""Encoding, token files and packing: round trips against the library."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from quiver.llm import packing, tokenfile, wavelet  # noqa: E402
from quiver.llm.encode import Encoder  # noqa: E402

BYTES, WORDS = str(P.path("byte_bpe_50k.json")), str(P.path("word_bpe_49k.json"))
ODD = ["", " ", "a  b", "a \nb", "\n a", "don't I'll we've  x", "Ωσ ΑΣ. Σ", "é b", "İstanbul I", "　x  y",
       "12 3.5% a1b", "œuvre cœur Œ", "<|endoftext|> hi", "a b ", "tab\t c", "日本語 テスト", "'s 't", "\x85 a",
       "a\x1c b", "foo, bar.   z", "ª º µ ß Ÿ", "á. x,y", ". , ..", "퟿ 😀 x"]


def _reference(path, texts, end):
    tok = tokenizers.Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return [np.array(e.ids + [end], dtype="<u4") for e in tok.encode_batch([t or "" for t in texts],
                                                                           add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_agrees_with_the_library(path, corpus):
    texts = ODD + [r[1] for r in corpus]
    encode = Encoder(path)
    for _ in range(2):
        for text, want in zip(texts, _reference(path, texts, 0)):
            assert encode(text) == want[:-1].tobytes(), text


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_batches_agree_with_the_library(path, corpus):
    texts = [None, *ODD, *[r[1] for r in corpus], "ÿþ. ÀÖ,\nçÿ. Ãé\nx", "\0 \1 a\1b", "# ##. a\nb.\n c", "</w> x</w>"]
    encode, want = Encoder(path), _reference(path, texts, 0)
    for size in (1, 7, len(texts)):
        for lo in range(0, len(texts), size):
            ids, counts = encode.many(pa.array(texts)[lo:lo + size])
            assert counts.tolist() == [len(w) - 1 for w in want[lo:lo + size]]
            assert ids.tolist() == [i for w in want[lo:lo + size] for i in w[:-1].tolist()]
    assert [len(x) for x in encode.many(pa.array([], pa.string()))] == [0, 0]


def test_batches_after_a_space(corpus):
    texts = [None, *ODD, *[r[1] for r in corpus]]
    ids, counts = Encoder(BYTES).many(pa.array(texts), after_space=True)
    want = _reference(BYTES, [" " + (t or "") for t in texts], 0)
    assert counts.tolist() == [len(w) - 1 for w in want]
    assert ids.tolist() == [i for w in want for i in w[:-1].tolist()]


def test_characters_without_an_id(monkeypatch, corpus):
    # lengths that fit no unit: every unit is encoded by itself
    encode, texts = Encoder(BYTES), [r[1] for r in corpus[:40]]
    encode.lengths[:] = 10 ** 6
    assert [encode(t) for t in texts] == [w[:-1].tobytes() for w in _reference(BYTES, texts, 0)]


@pytest.mark.parametrize("n, bits", [(0, 16), (1, 3), (511, 16), (512, 16), (5000, 17)])
def test_wavelet_matrix(n, bits):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % (1 << bits)).astype(np.uint32)
    shard = wavelet.Shard(wavelet.build(ids, np.array([4]), np.array([0]), np.array([n]), bits))
    assert (shard.decode() == ids).all() and shard.n == n
    for i in rng.integers(0, n, 20) if n else []:
        assert shard.access(int(i)) == ids[i]
    for s in [*ids[:5].tolist(), (1 << bits) - 1, 1 << bits]:
        places = np.flatnonzero(ids == s)
        assert shard.count(s) == len(places)
        assert shard.count(s, n // 3, n // 2) == (ids[n // 3:n // 2] == s).sum()
        for k in {0, len(places) // 2, len(places) - 1} if len(places) else ():
            assert shard.occurrence(s, k) == places[k]
        with pytest.raises(IndexError):
            shard.occurrence(s, len(places))


def test_token_files_round_trip(spark, clashing, corpus, empty):
    path = tokenfile.write_token_files(clashing, BYTES, 2, shard_ids=3000)
    shards, _ = tokenfile.read_shards(spark, path)
    assert shards.count() > 4
    got = tokenfile.read_documents(spark, path).collect()
    want = list(zip([r[0] for r in corpus], _reference(BYTES, [r[1] for r in corpus], 2)))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (d is not None, d or 0, len(x), zlib.crc32(x.tobytes())) for d, x in want)
    place = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens
    order = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)
    counts = {r.id: r.n for r in tokenfile.token_counts(spark, path, [2, 11, 60000]).collect()}
    flat = np.concatenate([x for _, x in want])
    assert counts == {s: int((flat == s).sum()) for s in (2, 11, 60000)}
    assert tokenfile.read_documents(spark, tokenfile.write_token_files(empty, BYTES, 2)).count() == 0


def test_best_fit_takes_the_smallest_room():
    bins, fill = packing.best_fit(np.array([6, 5, 4, 3, 5, 1, 10]), 10)
    assert fill.tolist() and fill.max() <= 10 and len(fill) == 4
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 101, 2000)
    bins, fill = packing.best_fit(sizes, 100)
    assert (np.bincount(bins, sizes) == fill).all() and fill.max() <= 100
    assert len(fill) <= 1.02 * sizes.sum() / 100 + 1


def _check_packing(rows, want, capacity):
    pieces = sorted((r.doc_id is not None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    cut = [(d is not None, d or 0, k, k * capacity, len(x[k * capacity:(k + 1) * capacity]),
            zlib.crc32(x[k * capacity:(k + 1) * capacity].tobytes()))
           for d, x in want for k in range(-(-len(x) // capacity))]
    assert pieces == sorted(cut)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for members in bins.values():
        place = 0
        for offset, length in sorted(members):
            assert offset == place
            place += length
        assert place <= capacity
    return len(bins), sum(len(x) for _, x in want)


def test_packing(clashing, corpus, empty):
    want = list(zip([r[0] for r in corpus], _reference(WORDS, [r[1] for r in corpus], 1)))
    bins, total = _check_packing(packing.pack_documents(clashing, WORDS, 1, 4096).collect(), want, 4096)
    assert bins == -(-total // 4096)
    bins, total = _check_packing(packing.pack_documents(clashing, WORDS, 1, 512).collect(), want, 512)
    assert bins <= -(-total // 512) + 1
    assert packing.pack_documents(empty, WORDS).count() == 0


def test_packing_in_rounds(spark, clashing, corpus):
    want = list(zip([r[0] for r in corpus], _reference(WORDS, [r[1] for r in corpus], 1)))
    pieces = packing.token_pieces(clashing, WORDS, 1, 512)
    rows = packing.pack_pieces(pieces, 512, items_per_task=10).collect()
    bins, total = _check_packing(rows, want, 512)
    assert bins <= 1.1 * total / 512 + 1
    # bins that never merge end the rounds
    halves = spark.range(90).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "300L AS length", "0L AS ids_crc32")
    assert packing.pack_pieces(halves, 512, items_per_task=10).select("sequence_id").distinct().count() == 90


def test_packing_meets_texts_in_batches_bounded_by_bytes(spark, monkeypatch):
    """Long texts do not make long Arrow batches: the bytes of each one, as its only piece."""
    def sizes(path, end_id, capacity):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[:1], pa.array([0], pa.int32()), pa.array([batch.num_rows], pa.int64()),
                     pa.array([1], pa.int64()), pa.array([batch.column(1).nbytes], pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
        return run

    monkeypatch.setattr(packing, "_pieces", sizes)
    docs = spark.range(0, 700, 1, 1).selectExpr("id AS doc_id", "repeat('some words ', 3000) AS text")
    got = packing.pack_documents(docs, WORDS).collect()
    assert sum(r.start for r in got) == 700
    assert len(got) > 3 and max(r.ids_crc32 for r in got) < 7 << 20
    # the session is as before, and a bound of its own is kept
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    assert key not in spark.conf.getAll
    spark.conf.set(key, 1 << 20)
    try:
        got = packing.pack_documents(docs, WORDS).collect()
        assert spark.conf.get(key) == str(1 << 20)
    finally:
        spark.conf.unset(key)
    assert sum(r.start for r in got) == 700 and max(r.ids_crc32 for r in got) < 2 << 20
