"""The pipeline, stage by stage against brute force and as a whole."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

import corpus_pipeline  # noqa: E402
from quiver.llm import mixing, queries  # noqa: E402

from . import brute  # noqa: E402

BAD = ["vile", "scummy", "grubbel"]


def _corpus():
    rng = random.Random(11)

    def text(n):
        return " ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 400)}" for _ in range(n))

    rows, toxic = [], {}
    for i in range(260):
        body = text(rng.randint(8, 90))
        if i % 5 == 0:
            words = body.split(" ")
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
            body = " ".join(words)
        elif i % 13 == 0:
            body = body + "\nall sites carry this line\n" + text(6)
        toxic[i] = int(i % 5 == 0)
        rows.append((i, body, "en", f"src{i % 12}", len(body)))
    base = text(120)
    for i in range(260, 275):
        near = base.split(" ")
        near[rng.randrange(120)] = "changed"
        rows.append((i, " ".join(near), "en", f"src{i % 12}", 0))
        toxic[i] = 0
    rows += [(275, None, None, None, None), (276, "", "en", "src1", 0), (277, text(6000), "de", "src3", 1), rows[7]]
    labels = [(i, 1, y) for i, y in toxic.items()]
    return rows, labels, toxic


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, labels, _ = _corpus()
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def _key(rows):
    return Counter((r.doc_id, r.text, r.source) for r in rows)


def test_stages_and_run(spark, folder):
    rows, _, toxic = _corpus()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line dedup", "n-gram Jaccard join", "mixing sources to target weights",
                            "best-fit packing"]

    kept = stages["toxicity"](spark, docs, folder)
    assert kept.columns == columns
    kept = kept.cache()
    assert _key(kept.collect()) == Counter((r[0], r[1], r[3]) for r in rows if not toxic.get(r[0], 0))

    before = kept.collect()
    cleaned = stages["line dedup"](spark, kept, folder)
    assert cleaned.columns == columns
    cleaned = cleaned.cache()
    cut = brute.cut_lines([(r.doc_id, r.source, r.text) for r in before], queries.MIN_SITES)
    assert _key(cleaned.collect()) == Counter((r.doc_id, c[2], r.source) for r, c in zip(before, cut))
    assert sum(c[1] for c in cut) > 5

    before = cleaned.collect()
    distinct = stages["n-gram Jaccard join"](spark, cleaned, folder)
    assert distinct.columns == columns
    distinct = distinct.cache()
    _, component = brute.components([(r.doc_id, r.text) for r in before])
    want = {(r.doc_id, r.text, r.source) for i, r in enumerate(before)
            if component[i] is None or component[i] == r.doc_id}
    assert _key(distinct.collect()) == Counter(want)
    assert not {r[0] for r in want} & set(range(261, 275))

    mixed = stages["mixing sources to target weights"](spark, distinct, folder)
    assert mixed.columns == columns
    mixed = mixed.cache()
    taken = defaultdict(int)
    for r in mixing.mix_sources(distinct, queries.MIX_CAP).collect():
        taken[r.doc_id] += r.taken
    words = defaultdict(int)
    for r in mixed.collect():
        words[r.doc_id] += len(brute.words(r.text))
    assert words == {d: n for d, n in taken.items() if n}

    packed = stages["best-fit packing"](spark, mixed, folder).collect()
    tok = tokenizers.Tokenizer.from_file(str(P.path("word_bpe_49k.json")))
    want = Counter()
    for r in mixed.collect():
        ids = np.array(tok.encode(r.text, add_special_tokens=False).ids + [queries.PACK_END_ID], dtype="<u4")
        for k in range(0, len(ids), queries.SEQUENCE):
            part = ids[k:k + queries.SEQUENCE]
            want[(r.doc_id, k // queries.SEQUENCE, k, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want

    ran = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in ran) == want
    used = defaultdict(int)
    for r in ran:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= queries.SEQUENCE


def test_stages_on_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
