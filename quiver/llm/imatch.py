"""Document fingerprints by I-Match over randomised lexicon subsets.

The lexicon are the terms of a band of inverse document frequency over all
documents: neither so common that unrelated texts share them, nor so rare
that their number grows with the corpus.  A text is its distinct lexicon
terms, sorted.  A random subset of the lexicon keeps each term with some
probability; the hash of the text's terms in it is one I-Match signature.  Two
rates of subsets are used per text, 2^-L and half of that for 2^L to 2^(L+1)
terms, so that a subset holds about one term of the text and a changed part
breaks some signatures only.  Likeness is the share of equal signatures among
those that are not empty on both sides.

Every text is compared with an edited form (its end replaced by the beginning
of the next document) and with the next document.  Documents are sorted over
range partitions and read in order, so the next one is at hand; the last one
of a partition is paired with the first one of the next in a small join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.session import attach, scratch_path
from .hashing import U, by_bytes, mix, word_hashes
from .shared import save
from .terms import LETTERS_AND_DIGITS, spaced_terms

# the band: share of all documents that a lexicon term is in
RAREST, COMMONEST = 1e-4, 0.02
# terms of the lexicon, 16 MB of hashes; a larger band begins at commoner terms
LEXICON = 2_000_000
# texts with a smaller share of lexicon terms are fingerprinted by all their terms
COVERED = 0.1
SUBSETS = 24
RATES = 2
HIGHEST = 14
EVERY = 0x20
CHUNK_CHARS = 4 << 20
# distinct terms that a task holds before it sends their counts
HELD_TERMS = 2_000_000
RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


class Prints(NamedTuple):
    """Fingerprints of some texts: kind (level, and whether all terms count; -1 none), signatures, hash of the text."""

    kind: np.ndarray
    signatures: np.ndarray
    whole: list[str]

    def part(self, which) -> Prints:
        return Prints(self.kind[which], self.signatures[which], self.whole[which])

    def shown(self) -> list[str]:
        return [f"{k:02x}{s.tobytes().hex()}" if k >= 0 else f"ff{w}"
                for k, s, w in zip(self.kind.tolist(), self.signatures, self.whole)]


def distinct_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each row's distinct terms, sorted."""
    terms, counts = word_hashes(spaced_terms(texts, LETTERS_AND_DIGITS))
    row = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((terms, row))
    row, terms = row[order], terms[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (terms[1:] != terms[:-1])
    return row[new], terms[new]


def fingerprints(texts: list[str], lexicon: np.ndarray) -> Prints:
    """Fingerprints of texts under a sorted array of lexicon term hashes."""
    rows = len(texts)
    row, terms = distinct_terms(pa.array(texts, pa.large_string()))
    every = np.bincount(row, minlength=rows)
    known = np.zeros(len(terms), dtype=bool)
    if len(lexicon):
        known = lexicon[np.minimum(np.searchsorted(lexicon, terms), len(lexicon) - 1)] == terms
    sparse = np.bincount(row[known], minlength=rows) < COVERED * every
    used = known | sparse[row]
    row, terms = row[used], terms[used]
    n = np.bincount(row, minlength=rows)
    level = np.minimum(np.log2(np.maximum(n, 1)).astype(np.int64), HIGHEST)
    signatures = np.zeros((rows, RATES, SUBSETS), dtype=np.uint32)
    filled = np.flatnonzero(n)
    begin = (np.cumsum(n) - n)[filled]
    value = mix(terms ^ U(0x243F6A8885A308D3))
    masks = [((1 << (level[row] + j)) - 1).astype(U) for j in range(RATES)]
    for s in range(SUBSETS if len(row) else 0):
        if s % 4 == 0:
            drawn = mix(terms + U(0x9E3779B97F4A7C15 * (s + 1) & 0xFFFFFFFFFFFFFFFF))
        lane = drawn >> U(16 * (s % 4))
        for j, mask in enumerate(masks):
            total = np.add.reduceat(np.where(lane & mask, U(0), value), begin)
            signature = np.maximum((mix(total) >> U(32)).astype(np.uint32), 1)
            signatures[filled, j, s] = np.where(total == 0, 0, signature)
    kind = np.where(n > 0, level + EVERY * sparse, -1)
    whole = ["" if k >= 0 else hashlib.sha256(t.encode()).hexdigest()[:16] for k, t in zip(kind.tolist(), texts)]
    return Prints(kind, signatures, whole)


def likeness(a: Prints, b: Prints) -> np.ndarray:
    """Per row, the share of equal signatures among the rates both have (0 to 1).

    Texts without terms are like their equals only, and so are texts of which
    one is fingerprinted by all its terms and the other is not.
    """
    met, same = np.zeros(len(a.kind)), np.zeros(len(a.kind))
    step = b.kind - a.kind
    usable = (a.kind >= 0) & (b.kind >= 0) & (a.kind // EVERY == b.kind // EVERY)
    for i in range(RATES):
        for j in range(RATES):
            pick = np.flatnonzero(usable & (step == i - j))
            x, y = a.signatures[pick, i], b.signatures[pick, j]
            filled = (x != 0) | (y != 0)
            met[pick] += filled.sum(axis=1)
            same[pick] += (filled & (x == y)).sum(axis=1)
    out = same / np.maximum(met, 1)
    equal = (a.kind == b.kind) & (a.signatures == b.signatures).all(axis=(1, 2))
    alike = np.array([x == y for x, y in zip(a.whole, b.whole)], dtype=bool)
    return np.where(equal & alike, 1.0, out)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of another."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def _results(ids: list, texts: list[str], following: list[str], own: Prints, after: Prints, lexicon: np.ndarray) -> list:
    changed = [edited(a, b) for a, b in zip(texts, following)]
    new = fingerprints(changed, lexicon)
    return [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array(own.shown(), pa.string()), pa.array(new.shown(), pa.string()),
            pa.array(likeness(own, new), pa.float64()), pa.array(likeness(own, after), pa.float64())]


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def added() -> tuple[np.ndarray, np.ndarray]:
        terms = np.concatenate([h[0] for h in held])
        order = np.argsort(terms, kind="stable")
        terms, counts = terms[order], np.concatenate([h[1] for h in held])[order]
        begin = np.flatnonzero(np.diff(terms, prepend=terms[:1] ^ U(1)) != 0)
        return terms[begin], np.add.reduceat(counts, begin) if len(begin) else counts[:0]

    def sent() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], names=["h", "df"])

    for part in (p for b in batches for p in by_bytes(b, 0, 8 << 20)):
        held.append((t := distinct_terms(part.column(0))[1], np.ones(len(t), np.int64)))
        held[:] = [added()]
        if len(held[0][0]) > HELD_TERMS:
            yield sent()
            held.clear()
    if held:
        yield sent()


def build_lexicon(docs: DataFrame, rarest: float = RAREST, commonest: float = COMMONEST) -> np.ndarray:
    """Sorted hashes of the terms in the band, from the document frequencies of all documents.

    At most ``LEXICON`` terms: where the band has more, ``rarest`` is doubled
    until it has not.
    """
    attach(docs.sparkSession)
    n = docs.count()
    known = save(docs.select("text").mapInArrow(_frequencies, "h long, df long").groupBy("h").agg(F.sum("df").alias("df"))
                 .filter((F.col("df") >= max(2.0, rarest * n)) & (F.col("df") <= commonest * n)), "lexicon")
    while known.count() > LEXICON:
        rarest *= 2
        known = known.filter(F.col("df") >= rarest * n)
    found = known.select("h").toArrow().column("h").combine_chunks().to_numpy()
    return np.sort(found.view(U))


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1),
             pa.array([squeeze((t.as_py() or "").encode()) for t in batch.column(2)], pa.binary())],
            names=["doc_id", "h", "z"])


def _unpacked(column: pa.Array) -> Iterator[str]:
    restore = zstandard.ZstdDecompressor().decompress
    return (restore(z.as_py()).decode() if z.is_valid else "" for z in column)


def _in_order(lexicon):
    """Results of a partition's documents in order; the first and the last also carry their text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids, texts, size, before, first = [], [], 0, None, True

        def results(last: bool) -> pa.RecordBatch:
            nonlocal before, first
            own = fingerprints(texts, lexicon.value)
            if before is not None:
                kept = before[2]
                own = Prints(*(np.concatenate([a, b]) for a, b in zip(kept[:2], own[:2])), kept[2] + own.whole)
                all_ids, all_texts = [before[0], *ids], [before[1], *texts]
            else:
                all_ids, all_texts = ids, texts
            n = len(all_ids) - 1
            columns = _results(all_ids[:n], all_texts[:n], all_texts[1:], own.part(slice(0, n)),
                               own.part(slice(1, n + 1)), lexicon.value)
            z = [None] * n
            if first and n:
                z[0] = zstandard.compress(all_texts[0].encode(), 1)
            flags = [first and i == 0 for i in range(n)]
            if last:
                ends = [all_ids[n], len(all_texts[n]), None, None, None, None, None]
                columns = [pa.concat_arrays([c, pa.array([e], c.type)]) for c, e in zip(columns, ends)]
                z.append(zstandard.compress(all_texts[n].encode(), 1))
                flags.append(first and n == 0)
            before, first = (all_ids[n], all_texts[n], own.part(slice(n, n + 1))), first and n == 0
            rows = len(z)
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array([part] * rows, pa.int32()), pa.array(flags, pa.bool_()),
                 pa.array([last and i == rows - 1 for i in range(rows)], pa.bool_()), pa.array(z, pa.binary())],
                names=[*_NAMES, "part", "first", "last", "z"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), _unpacked(batch.column(1))):
                if size >= CHUNK_CHARS:
                    yield results(False)
                    ids, texts, size = [], [], 0
                ids.append(doc)
                texts.append(text)
                size += len(text) + 64
        if ids:
            yield results(True)
    return run


def _paired(lexicon):
    """Results of documents that carry the text of the next one."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, following = list(_unpacked(batch.column(1))), list(_unpacked(batch.column(2)))
            own, after = fingerprints(texts, lexicon.value), fingerprints(following, lexicon.value)
            yield pa.RecordBatch.from_arrays(
                _results(batch.column(0).to_pylist(), texts, following, own, after, lexicon.value), names=_NAMES)
    return run


def fingerprint_documents(docs: DataFrame, rarest: float = RAREST, commonest: float = COMMONEST) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` per document.

    The next document is that of the next id (null ids first, rows of one id
    in the order of their text's hash; after the last comes the first, which
    for a single document is itself).  The edited text ends in the beginning of
    the next document in place of its own last quarter of code points.  A null
    text is empty.  Equal texts have equal fingerprints.  A text without terms
    (empty, or marks only) is like an equal one (1) and nothing else (0).  A
    text of which less than a tenth of its terms are in the lexicon is
    fingerprinted by all its terms.  Rows that repeat are documents of their
    own; no documents give no rows.
    """
    spark = docs.sparkSession
    attach(spark)
    lexicon = spark.sparkContext.broadcast(build_lexicon(docs, rarest, commonest))
    order = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    path = scratch_path(spark, "fingerprints")
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
     .mapInArrow(_packed, "doc_id long, h long, z binary")
     .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "z")
     .mapInArrow(_in_order(lexicon), f"{RESULT}, part int, first boolean, last boolean, z binary")
     .write.option("compression", "zstd").parquet(path))
    rows = spark.read.schema(f"{RESULT}, part int, first boolean, last boolean, z binary").parquet(path)
    # a row per partition
    heads = rows.filter("first").select("part", "z").withColumn("at", F.row_number().over(Window.orderBy("part")))
    tails = rows.filter("last").select("doc_id", "part", "z")
    places = heads.select("part", "at", F.count(F.lit(1)).over(Window.partitionBy()).alias("parts"))
    ends = (tails.join(places, "part").withColumn("after", F.col("at") % F.col("parts") + 1).drop("part", "at")
            .join(heads.select(F.col("at").alias("after"), F.col("z").alias("next_z")), "after"))
    completed = ends.select("doc_id", "z", "next_z").mapInArrow(_paired(lexicon), RESULT)
    return rows.filter(~F.col("last")).select(*_NAMES).unionByName(completed)
