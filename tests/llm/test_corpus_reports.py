"""Source divergence, document fingerprints and tokenizer alignment against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from quiver.llm import alignment, divergence, imatch, queries
from quiver.llm.terms import LETTERS, LOWERED, strings_at, term_spans, text_bytes

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return [t.translate(ASCII_LOWER) for t in TERM.findall(text or "")]


# ------------------------------------------------------------- divergence

def divergence_by_hand(rows, least, top):
    count, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        found = terms(text)
        count[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang in {g[0] for g in count}:
        kept = sorted((t for t, n in docs[lang].items() if n >= least), key=str.encode)
        groups = {s: c for (g, s), c in count.items() if g == lang}
        whole = Counter()
        for c in groups.values():
            whole.update(c)

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        for s, c in groups.items():
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            over = [(t, p[s][t] - q[t]) for t in kept if c[t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", over, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items[:most])]
    return sorted(out)


@pytest.fixture(scope="module")
def words():
    """Terms of all length buckets, with characters of one to four bytes."""
    rng = random.Random(3)
    made = ["".join(rng.choice("abXYzé漢👍") for _ in range(n)) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 16, 17, 40)
            for _ in range(6)] + ["x" * 300, "x" * 301, "X" * 300]
    rows = []
    for i in range(300):
        text = "".join(rng.choice(made) + rng.choice([" ", "1", "\n", "-", "_", "[", "\x7f"]) for _ in range(rng.randint(0, 60)))
        rows.append((i, text, rng.choice(["en", "de", None]), f"s{min(i % 12, 4)}" if i % 29 else None, 0))
    rows += [(900, "", "fr", "s1", 0), (901, None, "fr", "s2", 0), (902, "nothing", "fr", None, 0), rows[5], rows[5],
             (None, "abc abc", "xx", "lonely", 0)]
    return rows


@pytest.mark.parametrize("cells", [divergence.CELLS, 50])
def test_divergence(spark, words, monkeypatch, cells):
    monkeypatch.setattr(divergence, "CELLS", cells)
    docs = spark.createDataFrame(words, DOCS).repartition(5).selectExpr("*", "1 AS n", "2 AS term", "3 AS p")
    got = divergence.audit_sources(docs, 30, 7)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == divergence_by_hand(words, 30, 7)


def test_divergence_of_parts_and_empty_tables(spark, words, monkeypatch, empty):
    monkeypatch.setattr(divergence, "PART_BYTES", 100)
    docs = spark.createDataFrame(words, DOCS).repartition(3)
    assert sorted(map(tuple, divergence.audit_sources(docs, 20, 50).collect())) == divergence_by_hand(words, 20, 50)
    assert divergence.audit_sources(empty).count() == 0


def test_buckets_hold_every_term_sorted(words):
    texts = pa.array([w[1] for w in words])
    data, offsets = text_bytes(texts)
    data = LOWERED[data]
    row, starts, lengths = term_spans(data, offsets, LETTERS)
    assert strings_at(data, starts, lengths).to_pylist() == [t for w in words for t in terms(w[1])]
    seen = 0
    for at, new in divergence._buckets(data, starts, lengths):
        shown = [t.encode() for t in strings_at(data, starts[at], lengths[at]).to_pylist()]
        assert shown == sorted(shown)
        assert new.tolist() == [i == 0 or shown[i] != shown[i - 1] for i in range(len(shown))]
        assert all(np.diff(at)[~new[1:]] > 0)
        seen += len(at)
    assert seen == len(starts)


# ------------------------------------------------------------- fingerprints

def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def test_fingerprints(spark, monkeypatch, clashing, corpus):
    monkeypatch.setattr(imatch, "CHUNK_CHARS", 2000)
    rows = [r for r in corpus if r[0] is not None]
    ids = [r[0] for r in rows]
    rows = [r for r in rows if ids.count(r[0]) == 1]
    once = [r[0] for r in rows]
    got = imatch.fingerprint_documents(clashing.filter(clashing.doc_id.isin(once)))
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    got = {r.doc_id: r for r in got.collect()}
    rows = in_order(rows)
    assert sorted(got) == [r[0] for r in rows]
    texts = [r[1] or "" for r in rows]
    lexicon = imatch.build_lexicon(clashing.filter(clashing.doc_id.isin(once)))
    for i, (row, text) in enumerate(zip(rows, texts)):
        after = texts[(i + 1) % len(texts)]
        k = len(text) // 4
        changed = text[:len(text) - k] + after[:k]
        own, new, nxt = (imatch.fingerprints([t], lexicon) for t in (text, changed, after))
        r = got[row[0]]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (own.shown()[0], new.shown()[0])
        assert (r.near_edited, r.near_next) == (imatch.likeness(own, new)[0], imatch.likeness(own, nxt)[0])
    by_text = defaultdict(set)
    for row, text in zip(rows, texts):
        by_text[text].add(got[row[0]].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())


def test_lexicon_is_the_band_of_document_frequencies(spark, monkeypatch):
    monkeypatch.setattr(imatch, "HELD_TERMS", 3)
    rows = [(i, " ".join(f"w{k}" for k in range(1, 21) if i % k == 0) + " all all", "en", "s", 0) for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    df = Counter(t for r in rows for t in set(r[1].split()))
    hashes = dict(zip(sorted(df), imatch.word_hashes(pa.array(sorted(df)))[0].tolist()))
    band = sorted(hashes[t] for t, n in df.items() if 0.08 * 200 <= n <= 0.3 * 200)
    assert imatch.build_lexicon(docs, 0.08, 0.3).tolist() == band
    monkeypatch.setattr(imatch, "LEXICON", 5)
    assert 0 < len(imatch.build_lexicon(docs, 0.01, 0.3)) <= 5


def test_likeness_tells_edits_from_other_texts():
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.choice([20, 100, 400]))) for _ in range(300)]
    lexicon = np.sort(imatch.word_hashes(pa.array([f"w{i}" for i in range(5000)]))[0])
    own = imatch.fingerprints(texts, lexicon)
    new = imatch.fingerprints([imatch.edited(a, b) for a, b in zip(texts, texts[1:] + texts[:1])], lexicon)
    near, far = imatch.likeness(own, new), imatch.likeness(own, parts_of(own, [*range(1, 300), 0]))
    assert np.quantile(near, 0.05) > np.quantile(far, 0.98) and near.mean() > 0.35 and far.mean() < 0.05
    assert (imatch.likeness(own, own) == 1).all()
    marks = imatch.fingerprints(["...", "...", "", "!!", "a word"], lexicon)
    assert imatch.likeness(marks, parts_of(marks, [1, 2, 3, 4, 4])).tolist() == [1, 0, 0, 0, 1]


def parts_of(prints, places):
    return imatch.Prints(prints.kind[places], prints.signatures[places], [prints.whole[i] for i in places])


def test_fingerprints_of_few_documents(spark, empty):
    assert imatch.fingerprint_documents(empty).count() == 0
    one = imatch.fingerprint_documents(spark.createDataFrame([(5, "abcdefgh", "en", "s", 8)], DOCS)).collect()
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in one] == [(5, 8, hashlib.sha256(b"abcdefab").hexdigest())]
    rows = [(None, "n u l l", None, None, 0), (2, None, None, None, 0), (2, None, None, None, 0), (1, "x" * 9, None, None, 0)]
    got = imatch.fingerprint_documents(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_chars) for r in got) == [(False, 0, 7), (True, 1, 9), (True, 2, 0), (True, 2, 0)]


# ------------------------------------------------------------- alignment

def alignment_by_hand(rows, path_a, path_b):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    bytes_a, bytes_b = alignment.byte_level_tokens(a), alignment.piece_tokens(b)
    found, count = [], Counter()
    for row in rows:
        text = row[1] or ""
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        plain = b" " + text.encode()
        if not text or b"".join(bytes_a[i] for i in x) != plain or b"".join(bytes_b[i] for i in y) != plain:
            found.append((row[0], None))
            continue
        ends = [np.cumsum([len(t[i]) for i in ids]).tolist() for t, ids in ((bytes_a, x), (bytes_b, y))]
        groups, i, j = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            k, m = ends[0].index(e) + 1, ends[1].index(e) + 1
            groups.append((x[i:k], y[j:m]))
            i, j = k, m
        found.append((row[0], (len(x), len(y), groups)))
        count.update({(u, v) for g in groups for u in g[0] for v in g[1]})
    most = Counter()
    for (u, _), n in count.items():
        most[u] = max(most[u], n)
    out = []
    for doc, x in found:
        if x is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(u, v) for g in x[2] for u in g[0] for v in g[1]]
        shown = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in x[2])
        out.append((doc, x[0], x[1], len(x[2]), len(links), sum(count[p] == most[p[0]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(shown.encode()).hexdigest()))
    return Counter(out)


@pytest.fixture(scope="module")
def vocabularies():
    return queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("piece_bpe_32k.model")


ODD = ["", None, " ", "  two  spaces ", "\n\nlines\r\n", "▁ a mark", "<s> </s> <unk> <0x41> <|endoftext|>", "漢字かな 👍🏽 é é",
       "x" * 700, "\x00\x01", "tab\tand space", "don't won't", "123,456.78", "=" * 300 + " " + "-" * 200, "ﬁ ligature Å",
       "word", "word", "𝔘𝔫𝔦 ÄÖÜ ß", "한국어" * 60]


@pytest.mark.parametrize("windows,listed", [(alignment.WINDOWS, alignment.LISTED), (4, 1)])
def test_alignment(spark, vocabularies, corpus, monkeypatch, windows, listed):
    monkeypatch.setattr(alignment, "WINDOWS", windows)
    monkeypatch.setattr(alignment, "LISTED", listed)
    both = alignment.Aligner(*vocabularies)
    rows = [r[:2] for r in corpus if r[1] is None or len(r[1]) < 3000] + [(1000 + i, t) for i, t in enumerate(ODD)]
    encoded = [x for x in both.encoded([t or "" for _, t in rows]) if x]
    for x, found in zip(encoded, both.align(encoded)):
        alone = both.align([x])[0]
        assert found[:3] == alone[:3] and found[3].tolist() == alone[3].tolist() and found[4].tolist() == alone[4].tolist()
    assert len(both.windows) <= windows


@pytest.mark.parametrize("block_pairs", [alignment.BLOCK_PAIRS, 400])
def test_aligned_documents(spark, vocabularies, corpus, block_pairs):
    rows = [r[:2] for r in corpus if r[1] is None or len(r[1]) < 3000] + [(1000 + i, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4) \
        .selectExpr("*", "1 AS row", "2 AS pairs", "3 AS times")
    got = alignment.align_documents(docs, *vocabularies, block_pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == alignment_by_hand(rows, *vocabularies)


def test_alignment_of_equal_hashes(vocabularies, monkeypatch):
    """Windows that only agree in their hash are told apart."""
    texts = ["one two three four", "five six seven eight", "one two one two"]
    both = alignment.Aligner(*vocabularies)
    want = [(x[:3], x[3].tolist()) for x in both.align(both.encoded(texts))]
    monkeypatch.setattr(alignment, "mix", lambda h: h * np.uint64(0))
    assert [(x[:3], x[3].tolist()) for x in both.align(both.encoded(texts))] == want


def test_alignment_of_nothing(spark, vocabularies, empty):
    assert alignment.align_documents(empty, *vocabularies).count() == 0
    none = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert sorted(map(tuple, alignment.align_documents(none, *vocabularies).collect()), key=str) == \
        [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]
