"""Toxicity from the nearest labelled examples.

Texts become TF-IDF vectors over a vocabulary of terms that go with the label
in the training rows: words, and word beginnings that are as pure as the words
(their toxic share is at least that of all chosen words together).  The labelled
examples are in a block-max inverted index: beside its postings, a term keeps
the largest weight per block of examples, so a block whose bound is below the
k-th best cosine is never opened and the k nearest are exact.  Their votes,
weighted by similarity and shrunk towards the rate of examples without any
term, are the vote; the neighbours are its evidence.

The vote is calibrated: folds of the training rows are scored by vocabularies
and examples of the other folds, and the vote that parts toxic from clean rows best
(by F1) becomes the score ``THRESHOLD``.  A score comes from the text alone.

Training uses a bounded sample of labelled rows (``sample``), fit on all of
them up to that bound.  Document frequencies cover all documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.session import attach
from .shared import TEXT_BATCH, boxed, save, small_side, unboxed

SAMPLE = 30_000
# a term's chi-square with the label, and the least rows that have it
CHI = 30.0
SUPPORT = 5
# share of toxic ones among the rows that have a term
PURITY = 0.5
BEGINNINGS = (4, 5)
NEIGHBOURS = 15
SHRINK = 0.5
BLOCK = 64
THRESHOLD = 0.7
FOLDS = 4
REMEMBERED = 200_000
WORD = re.compile(r"\w+")


def word_terms(word: str) -> list[str]:
    """The word itself and its beginnings, marked by a star."""
    return [word] + [f"{word[:n]}*" for n in BEGINNINGS if len(word) > n]


class TermMemo(dict):
    """The vocabulary's terms of a word."""

    def __init__(self, terms: dict[str, int]):
        super().__init__()
        self.terms = terms

    def __missing__(self, word: str) -> tuple:
        found = tuple(self.terms[t] for t in word_terms(word) if t in self.terms)
        if len(self) < REMEMBERED:
            self[word] = found
        return found


def term_counts(text: str | None, memo: TermMemo) -> Counter:
    """How often each vocabulary term occurs in a whole text."""
    hits = [x for x in map(memo.__getitem__, WORD.findall((text or "").lower())) if x]
    return Counter(t for x in hits for t in x)


def vector(counts: Counter, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms and weights of a unit TF-IDF vector (none: the zero vector)."""
    terms = np.array(sorted(counts), dtype=np.int64)
    if not len(terms):
        return terms, np.zeros(0)
    weights = np.array([1 + math.log(counts[t]) for t in terms.tolist()]) * idf[terms]
    return terms, weights / math.sqrt(float((weights * weights).sum()))


class BlockMaxIndex:
    """Postings of labelled examples by term, with the largest weight per block."""

    def __init__(self, ids: list, labels: list, vectors: list, terms: int):
        self.ids, self.labels = ids, np.array(labels, dtype=np.float64)
        self.blocks = -(-len(ids) // BLOCK)
        rows = np.repeat(np.arange(len(ids)), [len(v[0]) for v in vectors]) if ids else np.zeros(0, int)
        term = np.concatenate([v[0] for v in vectors]) if ids else np.zeros(0, int)
        weight = np.concatenate([v[1] for v in vectors]) if ids else np.zeros(0)
        order = np.lexsort((rows, term))
        self.rows, self.weight = rows[order], weight[order]
        self.start = np.searchsorted(term[order], np.arange(terms + 1))
        # single precision, rounded up: a bound is never too small
        most = np.zeros(terms * self.blocks)
        np.maximum.at(most, term * self.blocks + rows // BLOCK, weight)
        self.bound = np.where(most > 0, np.nextafter(most.astype(np.float32), np.float32(2)), 0) \
            .astype(np.float32).reshape(terms, self.blocks)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine above 0 (ties: the earlier example), exactly."""
        if not len(terms) or not self.ids:
            return np.zeros(0, np.int64), np.zeros(0)
        bound = weights @ self.bound[terms].astype(np.float64)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        lists = [(self.rows[a:b], self.weight[a:b] * w) for a, b, w in
                 zip(self.start[terms], self.start[terms + 1], weights)]
        ends = [np.searchsorted(r, np.arange(self.blocks + 1) * BLOCK) for r, _ in lists]
        best, score, limit, at = np.zeros(0, np.int64), np.zeros(0), 0.0, 0
        while at < len(order) and bound[order[at]] >= limit - 1e-12:
            chosen = order[at:at + 8]
            at += 8
            got = np.zeros((len(chosen), BLOCK))
            for (rows, value), end in zip(lists, ends):
                for i, b in enumerate(chosen.tolist()):
                    lo, hi = end[b], end[b + 1]
                    if lo < hi:
                        got[i, rows[lo:hi] - b * BLOCK] += value[lo:hi]
            i, j = np.nonzero(got)
            best = np.concatenate([best, chosen[i] * BLOCK + j])
            score = np.concatenate([score, got[i, j]])
            if len(best) >= k:
                top = np.lexsort((best, -score))[:k]
                best, score = best[top], score[top]
                limit = score[-1]
        top = np.lexsort((best, -score))[:k]
        return best[top], score[top]


def _training_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each class and fold that have a term, added up per task."""
    rows: dict[tuple[int, int], Counter] = {(f, y): Counter() for f in range(FOLDS) for y in (0, 1)}
    for batch in batches:
        for text, toxic, fold in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            words = set(WORD.findall((text.as_py() or "").lower()))
            rows[fold, toxic].update({t for w in words for t in word_terms(w)})
    for f in range(FOLDS):
        terms = list(rows[f, 0] | rows[f, 1])
        for lo in range(0, len(terms), 50_000):
            part = terms[lo:lo + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), pa.array([f] * len(part), pa.int32()),
                 pa.array([rows[f, 1][t] for t in part], pa.int64()),
                 pa.array([rows[f, 0][t] for t in part], pa.int64())], names=["term", "fold", "with1", "with0"])


def _vocabularies(train: DataFrame) -> list[set[str]]:
    """The vocabulary of all training rows, and one without each fold."""
    size = {(r["fold"], r["toxic"]): r["n"] for r in
            train.groupBy("fold", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    sides = [[f for f in range(FOLDS) if f != left] for left in (None, *range(FOLDS))]
    in_side = [F.col("fold").isin(side) for side in sides]
    stats = save(train.select("text", "toxic", "fold")
                 .mapInArrow(_training_counts, "term string, fold int, with1 long, with0 long").groupBy("term")
                 .agg(*[F.sum(F.when(c, F.col(f"with{y}")).otherwise(0)).cast("double").alias(f"{x}{g}")
                        for g, c in enumerate(in_side) for x, y in (("a", 1), ("b", 0))])
                 .filter(F.col("a0") + F.col("b0") >= SUPPORT), "term-counts", TEXT_BATCH)
    whole, tests, chis = ~F.col("term").endswith("*"), [], []
    for g, side in enumerate(sides):
        n1, n0 = (sum(size.get((f, y), 0) for f in side) for y in (1, 0))
        a, b = F.col(f"a{g}"), F.col(f"b{g}")
        chi = (float(n1 + n0) * F.pow(a * (n0 - b) - b * (n1 - a), 2)
               / ((a + b) * (float(n1 + n0) - a - b) * float(max(n1, 1)) * float(max(n0, 1))))
        fits = (a + b >= SUPPORT) & (a >= PURITY * (a + b)) & (a + b < n1 + n0)
        chis.append(F.when(fits, chi))
        tests.append(chis[g] >= CHI)
    # toxic share of the chosen words together, which a beginning must reach
    share = stats.agg(*[(F.sum(F.when(t & whole, F.col(f"a{g}")))
                         / F.sum(F.when(t & whole, F.col(f"a{g}") + F.col(f"b{g}")))).alias(f"s{g}")
                        for g, t in enumerate(tests)]).first()
    out = []
    for g, test in enumerate(tests):
        least = PURITY if share[g] is None else share[g]
        pure = F.col(f"a{g}") >= least * (F.col(f"a{g}") + F.col(f"b{g}"))
        # terms of a bounded sample: its size bounds their number
        out.append({r["term"] for r in stats.filter(test & (whole | pure)).select("term").collect()})
    return out


def _frequencies(vocabulary):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, have, n = TermMemo(vocabulary.value), Counter(), 0
        for batch in batches:
            n += batch.num_rows
            for text in batch.column(0):
                have.update(term_counts(text.as_py(), memo).keys())
        # the term -1 counts documents
        yield pa.RecordBatch.from_arrays([pa.array([-1, *have], pa.int64()), pa.array([n, *have.values()], pa.int64())],
                                         names=["term", "n"])
    return run


def _vectors(vocabulary, idf: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = TermMemo(vocabulary.value)
        for batch in batches:
            found = [vector(term_counts(t.as_py(), memo), idf) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([f[0] for f in found], pa.list_(pa.int64())),
                 pa.array([f[1] for f in found], pa.list_(pa.float64()))],
                names=["doc_id", "toxic", "fold", "terms", "weights"])
    return run


def restricted(terms: np.ndarray, weights: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The unit vector of the terms that have a place, under these places."""
    at = place[terms]
    inside = at >= 0
    at, weights = at[inside], weights[inside]
    return at, weights / math.sqrt(float((weights * weights).sum())) if len(at) else weights


def fit(rows: list[tuple], place: np.ndarray) -> tuple[BlockMaxIndex, float]:
    """Index of (id, label, terms, weights) rows over the terms with a place, and the rate of rows without any."""
    cut = [(r[0], r[1], restricted(r[2], r[3], place)) for r in rows]
    with_terms = [r for r in cut if len(r[2][0])]
    without = [r[1] for r in cut if not len(r[2][0])]
    base = (sum(without) + 0.01) / (len(without) + 1) if rows else 0.0
    return BlockMaxIndex([r[0] for r in with_terms], [r[1] for r in with_terms],
                         [r[2] for r in with_terms], int((place >= 0).sum())), base


def vote(index: BlockMaxIndex, base: float, near: np.ndarray, cosine: np.ndarray) -> float:
    return float(((cosine * index.labels[near]).sum() + SHRINK * base) / (cosine.sum() + SHRINK))


def _fold_votes(model):
    """Votes on training rows by the other folds."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folds, k = model.value
        for batch in batches:
            votes = []
            for fold, terms, weights in zip(*(c.to_pylist() for c in batch.columns[2:])):
                index, base, place = folds[fold]
                v = restricted(np.array(terms, np.int64), np.array(weights, np.float64), place)
                votes.append(vote(index, base, *index.nearest(*v, k)))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(votes, pa.float64())], names=["toxic", "vote"])
    return run


def best_cut(votes: np.ndarray, toxic: np.ndarray) -> float:
    """The vote from which calling rows toxic has the largest F1: mid between two votes, ties the widest gap."""
    order = np.argsort(-votes, kind="stable")
    votes, toxic = votes[order], toxic[order]
    hits, called = np.cumsum(toxic), np.arange(1, len(votes) + 1)
    gap = votes - np.append(votes[1:], 0.0)
    f1 = np.where(gap > 0, 2 * hits / (called + toxic.sum()), -1.0)
    best = max(range(len(votes)), key=lambda i: (round(f1[i], 12), gap[i]))
    return float(votes[best] - gap[best] / 2)


def cut_of(votes: np.ndarray, toxic: np.ndarray) -> float:
    """The best cut, or the threshold itself where training rows are all of one label."""
    return best_cut(votes, toxic) if toxic.any() and not toxic.all() else THRESHOLD


def calibrated(value: float, cut: float) -> float:
    """A vote on the scale where its cut is ``THRESHOLD``, straight on both sides."""
    if value < cut:
        return value * THRESHOLD / cut
    return THRESHOLD + (value - cut) * (1 - THRESHOLD) / (1 - cut) if cut < 1 else 1.0


def _score(model):
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, idf, index, base, cut, k = model.value
        memo = TermMemo(vocabulary)
        for batch in batches:
            scores, shown = [], []
            for text in batch.column(1):
                near, cosine = index.nearest(*vector(term_counts(text.as_py(), memo), idf), k)
                scores.append(calibrated(vote(index, base, near, cosine), cut))
                shown.append([{"doc_id": index.ids[i], "similarity": float(c), "toxic": int(y)}
                              for i, c, y in zip(near.tolist(), cosine, index.labels[near])])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(scores, pa.float64()), pa.array(shown, evidence)],
                names=["doc_id", "fp", "score", "evidence"])
    return run


def held_out(doc_id: Column) -> Column:
    """Whether a row's label may not be learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE,
                    neighbours: int = NEIGHBOURS) -> DataFrame:
    """``(doc_id, fp, score, evidence)``, a row for each document.

    ``score`` is in 0 to 1 and depends on the text alone; ``evidence`` lists
    the nearest examples (id, cosine, label); ``fp`` is a hash of the text.
    Labels are learnt from rows that are not held out, with a label 0 or 1;
    several labels of one document count as their largest.  Null and empty
    texts, and texts without any term of the vocabulary, get the base rate of
    such examples (0 without labelled rows), on the calibrated scale, and no
    evidence.
    """
    return _scored(docs, _model(docs, labels, sample, neighbours))


def _scored(docs: DataFrame, model) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias("fp")).mapInArrow(
        _score(model), "doc_id long, fp long, score double, "
                       "evidence array<struct<doc_id:bigint,similarity:double,toxic:int>>")


def _model(docs: DataFrame, labels: DataFrame, sample: int, neighbours: int):
    """A broadcast of all that a score needs: vocabulary, weights, index, cut."""
    spark = docs.sparkSession
    attach(spark)
    known = save(labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
                 .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "labels")
    n = known.count()
    drawn = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample / max(n, 1))))
    drawn = save(drawn.limit(2 * sample).withColumnRenamed("doc_id", "l_id"), "labelled-sample")
    # copies of a text are in one fold
    train = save(docs.select("doc_id", "text").join(small_side(drawn, 16), F.col("doc_id") == F.col("l_id"))
                 .select("doc_id", "toxic", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold"),
                         "text"), "labelled-texts")
    chosen = _vocabularies(train)
    every = sorted(set().union(*chosen))
    vocabulary = {t: i for i, t in enumerate(every)}
    inside = [np.array([t in c for t in every], dtype=bool) for c in chosen]
    place = [np.where(k, np.cumsum(k) - 1, -1) for k in inside]
    shared = spark.sparkContext.broadcast(vocabulary)

    having = save(docs.select("text").mapInArrow(_frequencies(shared), "term long, n long")
                  .groupBy("term").agg(F.sum("n").alias("n")), "term-documents", TEXT_BATCH)
    counted = {r["term"]: r["n"] for r in having.collect()}
    total = counted.get(-1, 0)
    idf = np.array([math.log((1 + total) / (1 + counted.get(t, 0))) + 1 for t in range(len(vocabulary))])

    # a row per labelled sample row, of vocabulary terms only: bounded by the sample
    drawn_vectors = save(train.mapInArrow(_vectors(shared, idf), "doc_id long, toxic int, fold int, "
                                          "terms array<long>, weights array<double>"), "labelled-vectors", TEXT_BATCH)
    shared.destroy()
    examples = drawn_vectors.toArrow()
    # in an order that no id decides: equal cosines go to the earlier example
    rows = sorted(zip(*(examples.column(c).to_pylist() for c in ("doc_id", "toxic", "terms", "weights", "fold"))),
                  key=lambda r: (r[2], r[3], r[1], r[0]))
    rows = [(r[0], r[1], np.array(r[2], np.int64), np.array(r[3], np.float64), r[4]) for r in rows]
    folds = spark.sparkContext.broadcast(
        ([(*fit([r for r in rows if r[4] != f], place[f + 1]), place[f + 1]) for f in range(FOLDS)], neighbours))
    votes = drawn_vectors.mapInArrow(_fold_votes(folds), "toxic int, vote double").toArrow()
    folds.destroy()
    cut = cut_of(votes.column("vote").to_numpy(), votes.column("toxic").to_numpy())
    index, base = fit(rows, place[0])
    own = {t: int(place[0][i]) for t, i in vocabulary.items() if inside[0][i]}
    return spark.sparkContext.broadcast((own, idf[inside[0]], index, base, cut, neighbours))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more."""
    model = _model(docs, labels, SAMPLE, NEIGHBOURS)
    toxic = save(_scored(docs, model).filter(F.col("score") >= threshold)
                 .select(F.col("doc_id").alias("t_id"), F.col("fp").alias("t_fp")).distinct(), "toxic", TEXT_BATCH)
    model.destroy()
    kept = boxed(docs).withColumn("fp", F.xxhash64("v.text")).join(
        small_side(toxic, 24), F.col("v.doc_id").eqNullSafe(F.col("t_id")) & (F.col("fp") == F.col("t_fp")),
        "left_anti")
    return unboxed(kept, docs.columns)
