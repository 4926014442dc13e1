"""Source divergence audit: how sources of a language differ in their terms.

Terms are counted per (language, source) in numpy by length-bucketed packing:
terms of up to 16 bytes become one or two unsigned 64-bit words (bytes in
order, zeros behind) and are radix-sorted by as many 16-bit digits as their
length bucket has; longer terms lie in buckets of doubling width that are
sorted as bytes.  Rows enter in order of their group, and all sorts are
stable, so runs of a sorted bucket give a term's occurrences and documents
per group at once.  Tasks send these sums; Spark adds them up, keeps the
frequent terms, and takes shares, differences and ranks in exact integers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.session import attach
from .hashing import U, by_bytes
from .shared import save, small_side
from .terms import LETTERS, LOWERED, strings_at, term_spans, text_bytes

LEAST_DOCUMENTS = 30
TOP = 50
SMOOTHING = 5
SCALE = 1_000_000_000
# text whose terms are sorted together
PART_BYTES = 8 << 20
# (longest term, 16-bit digits to sort by) of the packed buckets
PACKED = ((2, 1), (4, 2), (6, 3), (8, 4), (12, 6), (16, 8))
# cells (sources x terms) of one task's table of shares
CELLS = 1 << 21


def packed_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, words: int) -> list[np.ndarray]:
    """Each span as ``words`` 64-bit words, first byte highest, zeros behind its end."""
    held = np.concatenate([data, np.zeros(8 * words, np.uint8)])
    every = np.ndarray((len(data) + 8 * (words - 1) + 1,), ">u8", held, strides=(1,))
    out = []
    for w in range(words):
        left = np.clip(lengths - 8 * w, 0, 8)
        shift = (8 * (8 - np.maximum(left, 1))).astype(U)
        value = (every[starts + 8 * w].astype(U) >> shift) << shift
        out.append(np.where(left > 0, value, U(0)))
    return out


def radix_order(words: list[np.ndarray], digits: int) -> np.ndarray:
    """Stable order by the leading 16-bit digits, sorted from the last digit to the first."""
    order = np.arange(len(words[0]))
    for d in range(digits - 1, -1, -1):
        digit = (words[d // 4] >> U(48 - 16 * (d % 4))).astype(np.uint16)
        order = order[np.argsort(digit[order], kind="stable")]
    return order


def _buckets(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length bucket: its terms in sorted order, and which of them differ from the one before."""
    shortest = 0
    for longest, digits in PACKED:
        pick = np.flatnonzero((lengths > shortest) & (lengths <= longest))
        shortest = longest
        if len(pick):
            words = packed_words(data, starts[pick], lengths[pick], 1 if longest <= 8 else 2)
            order = radix_order(words, digits)
            new = np.ones(len(pick), dtype=bool)
            new[1:] = np.logical_or.reduce([w[order[1:]] != w[order[:-1]] for w in words])
            yield pick[order], new
    while shortest < lengths.max(initial=0):
        width = 2 * shortest
        pick = np.flatnonzero((lengths > shortest) & (lengths <= width))
        shortest = width
        if len(pick):
            size = lengths[pick]
            rows = np.zeros(len(pick) * width, np.uint8)
            inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            rows[np.repeat(np.arange(len(pick)) * width, size) + inside] = data[np.repeat(starts[pick], size) + inside]
            terms = rows.view(f"S{width}")
            order = np.argsort(terms, kind="stable")
            new = np.ones(len(pick), dtype=bool)
            new[1:] = terms[order[1:]] != terms[order[:-1]]
            yield pick[order], new


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term in each group of a part."""
    for part in (p for b in batches for p in by_bytes(b, 2, PART_BYTES)):
        lang, source = (pc.fill_null(part.column(i), "").dictionary_encode() for i in (0, 1))
        code = lang.indices.to_numpy().astype(np.int64) * max(1, len(source.dictionary)) + source.indices.to_numpy()
        by_group = np.argsort(code, kind="stable")
        code = code[by_group]
        data, offsets = text_bytes(part.column(2).take(pa.array(by_group)))
        data = LOWERED[data]
        row, starts, lengths = term_spans(data, offsets, LETTERS)
        group = code[row]
        for at, new in _buckets(data, starts, lengths):
            g, r = group[at], row[at]
            run, doc = new.copy(), new.copy()
            run[1:] |= g[1:] != g[:-1]
            doc[1:] |= r[1:] != r[:-1]
            begin = np.flatnonzero(run)
            lang_code, source_code = np.divmod(g[begin], max(1, len(source.dictionary)))
            head = at[begin]
            yield pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(lang_code)), source.dictionary.take(pa.array(source_code)),
                 strings_at(data, starts[head], lengths[head]), pa.array(np.diff(begin, append=len(at)), pa.int64()),
                 pa.array(np.add.reduceat(doc.astype(np.int64), begin), pa.int64())],
                names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents, null values as empty strings."""
    attach(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return (rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def _share(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + SMOOTHING) / (total + SMOOTHING * terms)), exactly."""
    up = f"CAST({n} + {SMOOTHING} AS DECIMAL(20,0)) * {SCALE}BD"
    return F.expr(f"CASE WHEN {terms} > 0 THEN 1 + ({up}) div "
                  f"CAST({total} + {SMOOTHING} * {terms} AS DECIMAL(20,0)) END").cast("long")


def _pair_sums(table: pa.Table) -> pa.Table:
    """Sums of absolute differences of all pairs of sources over a block of terms.

    Rows without a term give a source's share of a term it does not have.
    """
    gid, p = table.column("gid").to_numpy(), table.column("p").to_numpy(zero_copy_only=False)
    term = table.column("term").combine_chunks().dictionary_encode()
    none = term.is_null().to_numpy(zero_copy_only=False)
    order = np.argsort(gid[none], kind="stable")
    sources = gid[none][order]
    width = len(term.dictionary)
    share = np.repeat(np.nan_to_num(p[none][order].astype(np.float64)).astype(np.int64)[:, None], width, axis=1)
    share[np.searchsorted(sources, gid[~none]), term.indices.drop_null().to_numpy()] = p[~none]
    a, b, value = [], [], []
    for i in range(len(sources) - 1):
        a.append(np.full(len(sources) - 1 - i, sources[i]))
        b.append(sources[i + 1:])
        value.append(np.abs(share[i + 1:] - share[i]).sum(axis=1))
    none = np.zeros(0, np.int64)
    return pa.table({c: pa.array(np.concatenate([none, *v]), pa.int64()) for c, v in
                     (("a", a), ("b", b), ("value", value))})


def audit_sources(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: distances between sources, and what each overuses.

    A language keeps the terms that ``least_documents`` of its documents
    have.  A source's share of a kept term is ``1 + floor(SCALE * (n + 5) /
    (N + 5 V))`` with its ``n`` occurrences of the term, ``N`` of all V kept
    ones.  Part ``pair``: each other source of the language with the sum of
    differences of all shares.  Part ``term``: the ``top`` terms of a source
    whose share exceeds the language's most.  Ranks go by value, then by item.

    Null and empty values are the group ''.  A group without terms is compared
    like any other; in a language without kept terms all distances are 0.
    Rows that repeat count each time; no documents give no rows.
    """
    counts = save(term_counts(docs), "term-counts")
    kept = save(counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("docs").alias("docs"))
                .filter(F.col("docs") >= least_documents).select("lang", "term", "all"), "kept-terms")
    held = save(counts.join(small_side(kept, 64), ["lang", "term"]).select("lang", "source", "term", "n", "all"),
                "kept-counts")
    everyone = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")])
    own = held.groupBy("lang", "source").agg(F.sum("n").alias("own_total"))
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("all").alias("all_total"))
    groups = save(everyone.distinct().join(own, ["lang", "source"], "left").join(terms, "lang", "left")
                  .na.fill(0, ["own_total", "terms", "all_total"])
                  .withColumn("gid", F.monotonically_increasing_id()), "groups")
    n_groups = groups.count()
    blocks = groups.groupBy("lang").agg(F.greatest(F.lit(1), F.ceil(F.max("terms") * F.count(F.lit(1)) / F.lit(CELLS)))
                                        .cast("int").alias("blocks"))
    sources = groups.join(blocks, "lang")
    shares = save(held.join(small_side(sources, 96, n_groups), ["lang", "source"])
                  .select("lang", "source", "gid", "term", "n", "blocks", _share("n", "own_total", "terms").alias("p"),
                          _share("`all`", "all_total", "terms").alias("q")), "shares")

    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    over = (shares.filter((F.col("n") > 0) & (F.col("p") > F.col("q")))
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    (F.col("p") - F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top))

    absent = sources.select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "gid",
                            F.lit(None).cast("string").alias("term"),
                            _share("0", "own_total", "terms").alias("p"))
    present = shares.select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "gid",
                            "term", "p")
    apart = save(absent.unionByName(present).groupBy("lang", "block")
                 .applyInArrow(_pair_sums, "a long, b long, value long")
                 .groupBy("a", "b").agg(F.sum("value").alias("value")), "distances")
    both = apart.unionByName(apart.select(F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = small_side(groups.select("gid", "lang", "source"), 64, n_groups)
    pairs = (both.join(names.withColumnRenamed("gid", "a"), "a")
             .join(names.select(F.col("gid").alias("b"), F.col("source").alias("item")), "b")
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
             .withColumn("rank", F.row_number().over(by_value)))
    return pairs.unionByName(over)
