"""Cross-tokenizer alignment: which ids of two vocabularies cover the same bytes.

A whole text is encoded by both tokenizers.  Anchors are the places before a
space-marked token where both tokenizers have a token end at the same byte
(checked on the byte offsets of all ends).  They split the document into windows
of token ids; a window's groups and links depend on its ids alone, so a worker
remembers them by the id tuples of both sides.

The number of documents that hold an id pair is a Spark aggregation over the
distinct pairs of each document.  The resulting table meets the documents'
pairs in blocks of bounded size, so it may grow beyond any broadcast.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import attach, scratch_path
from .encode import BATCH_BYTES, Encoder, byte_alphabet
from .hashing import U, by_bytes, mix
from .shared import save

# windows a worker remembers (at about 400 bytes each), and the longest such window in tokens
WINDOWS = 150_000
LONGEST = 48
# text that is aligned together: some 70 MB of arrays
PART_BYTES = 1 << 20
# links of a group that are listed one by one; of a longer group each pair is listed once
LISTED = 1024
# pairs of the count table that one broadcast holds (17 bytes each)
BLOCK_PAIRS = 2_000_000
# a document's pairs: many more than its groups make them listed once, with their times
HELD = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, " \
       "pairs array<long>, times array<long>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def byte_level_tokens(tokenizer) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary (added tokens: their text)."""
    byte = {c: b for b, c in byte_alphabet().items()}
    out = []
    for i in range(tokenizer.get_vocab_size()):
        token = tokenizer.id_to_token(i) or ""
        out.append(bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode())
    return out


def piece_tokens(processor) -> list[bytes]:
    """The bytes of every id of a piece vocabulary with a space mark and byte pieces."""
    return [bytes([int(processor.id_to_piece(i)[3:5], 16)]) if processor.is_byte(i)
            else processor.id_to_piece(i).replace("▁", " ").encode() for i in range(processor.get_piece_size())]


class Aligner:
    """Both tokenizers of a worker, and the windows it remembers."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a, self.b = Encoder(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = byte_level_tokens(self.a.tok), piece_tokens(self.b)
        # no space mark behind another character
        self.cuttable = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(len(self.bytes_b)))
        self.sizes = tuple(np.array([len(t) for t in x]) for x in (self.bytes_a, self.bytes_b))
        self.marked = tuple(np.array([t[:1] == b" " for t in x]) for x in (self.bytes_a, self.bytes_b))
        self.width = len(self.bytes_b)
        # without a normalizer and with an id for every byte, side a gives back any text
        self.lossless = self.a.norm is None and {bytes([b]) for b in range(256)} <= set(self.bytes_a)
        # every id's decimal digits and a place behind them, in one row
        names = [str(i).encode() for i in range(max(len(self.bytes_a), self.width))]
        self.digits = np.array([len(x) + 1 for x in names])
        self.names = np.frombuffer(b"".join(x.ljust(8) for x in names), np.uint8).reshape(-1, 8)
        self.windows: dict[tuple[bytes, bytes], tuple] = {}
        self.older: dict[tuple[bytes, bytes], tuple] = {}

    def encoded(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of both sides of each text, if both give back a space and the text byte by byte."""
        held = pa.array(texts, pa.string())
        ids, counts = self.a.many(held, after_space=True)
        return self._checked(texts, ids, np.cumsum(counts), self.side_b(held))

    def parts(self, batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[tuple[bytes, bytes] | None]]]:
        """Parts of a batch of rows (texts in column 2) that are aligned together, and their ids; each side is encoded in one go."""
        ids, counts = self.a.many(batch.column(2), after_space=True)
        stops, done, side_b = np.append(0, np.cumsum(counts)), 0, self.side_b(batch.column(2))
        for part in by_bytes(batch, 2, PART_BYTES):
            end = done + part.num_rows
            own = stops[done:end + 1]
            texts = [t or "" for t in part.column(2).to_pylist()]
            yield part, self._checked(texts, ids[own[0]:own[-1]], own[1:] - own[0], side_b[done:end])
            done = end

    def _checked(self, texts: list[str], ids: np.ndarray, stops: np.ndarray,
                 side_b: list[bytes | None]) -> list[tuple[bytes, bytes] | None]:
        out, raw, ends = [], ids.tobytes(), (4 * stops).tolist()
        for text, i, j, ids_b in zip(texts, [0, *ends], ends, side_b):
            ids_a = raw[i:j]
            back = ids_b is not None and (self.lossless or b"".join(
                map(self.bytes_a.__getitem__, array("I", ids_a))) == b" " + text.encode())
            out.append((ids_a, ids_b) if back else None)
        return out

    def gives_back(self, ids: Iterable[int], text: str) -> bool:
        return b"".join(map(self.bytes_b.__getitem__, ids)) == b" " + text.encode()

    def side_b(self, texts: pa.Array) -> list[bytes | None]:
        """Ids of side b of each text; None where they do not give back a space and the text, or there is none.

        Where no entry of the vocabulary has a space mark behind another
        character, a text's ids are those of its space-separated pieces, so
        each distinct piece is encoded once.  Texts with empty pieces (spaces
        side by side or at an end) are encoded whole.
        """
        if not len(texts):
            return []
        lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
        ends = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        pieces, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        found = self.b.encode(pieces, num_threads=1)
        size = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), "<u4", int(size.sum()))
        filled = [p for p in pieces if p]
        stops = np.cumsum(self.sizes[1][ids])[np.cumsum(size)[size > 0] - 1]
        plain = np.array([len(p.encode()) + 1 for p in filled])
        if len(stops) == len(plain) and (stops == np.cumsum(plain)).all() and self.gives_back(ids.tolist(), " ".join(filled)):
            good = np.array([p != "" for p in pieces])
        else:
            good = np.array([p != "" and self.gives_back(x, p) for p, x in zip(pieces, found)])
        like = np.logical_and.reduceat(good[codes], ends[:-1])
        empty = np.array([p == "" for p in pieces])
        apart = np.logical_or.reduceat(empty[codes], ends[:-1]) | (not self.cuttable)
        _, flat = _gathered(ids, size, codes)
        raw = flat.astype("<u4").tobytes()
        each = np.add.reduceat(size[codes], ends[:-1])
        ends_b = (4 * np.cumsum(each)).tolist()
        out = [raw[i:j] if ok else None for ok, i, j in zip(like.tolist(), [0, *ends_b], ends_b)]
        for r in np.flatnonzero(apart).tolist():
            text = texts[r].as_py()
            own = self.b.encode(text, num_threads=1) if text else []
            out[r] = array("I", own).tobytes() if text and self.gives_back(own, text) else None
        return out

    def windows_of(self, a: np.ndarray, b: np.ndarray, docs_a: np.ndarray, docs_b: np.ndarray):
        """First tokens (of both sides) of the windows of documents laid end to end.

        ``docs_a`` and ``docs_b`` are the documents' first tokens.  A window
        begins with a document and at every anchor in it.
        """
        cut_a, cut_b = self.marked[0][a], self.marked[1][b]
        cut_a[docs_a] = cut_b[docs_b] = True
        after_a, after_b = np.flatnonzero(cut_a), np.flatnonzero(cut_b)
        size_a, size_b = self.sizes[0][a], self.sizes[1][b]
        begin_a, begin_b = (np.cumsum(size_a) - size_a)[after_a], (np.cumsum(size_b) - size_b)[after_b]
        at = np.searchsorted(begin_b, begin_a)
        shared = np.append(begin_b, -1)[at] == begin_a
        return after_a[shared], after_b[at[shared]]

    def aligned(self, keys: list[tuple[bytes, bytes]]) -> list[tuple]:
        """Of each window its groups as text (a mark behind each), their number, its links as pair codes, and their times where not all 1.

        Windows are laid end to end: both sides of a window have equal length,
        so shared ends of the whole are shared ends of its windows.
        """
        a, b = (np.frombuffer(b"".join([k[i] for k in keys]), "<u4").astype(np.int64) for i in (0, 1))
        count_a, count_b = (np.array([len(k[i]) // 4 for k in keys]) for i in (0, 1))
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        last_a = ends_b[np.searchsorted(ends_b, ends_a)] == ends_a
        last_b = ends_a[np.searchsorted(ends_a, ends_b)] == ends_b
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        of_a, of_b = np.bincount(group_a), np.bincount(group_b)
        first_a, first_b = np.cumsum(of_a) - of_a, np.cumsum(of_b) - of_b
        # text: a group's ids of side a, then those of side b, each with a mark behind it
        at_a, at_b = np.arange(len(a)) + first_b[group_a], np.arange(len(b)) + (first_a + of_a)[group_b]
        ids, marks = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.uint8)
        ids[at_a], ids[at_b] = a, b
        marks[at_a] = np.where(last_a, ord("|"), ord(","))
        marks[at_b] = np.where(last_b, ord(";"), ord(","))
        digits = self.digits[ids]
        stop = np.cumsum(digits)
        shown = self.names[ids][np.arange(8) < digits[:, None]]
        shown[stop - 1] = marks
        text = shown.tobytes().decode("ascii")
        token_end = np.cumsum(count_a + count_b)
        text_end = stop[token_end - 1].tolist()
        # links: all pairs of a group, windows with a long group apart
        links = of_a * of_b
        group_end = group_a[np.cumsum(count_a) - 1] + 1
        most = np.maximum.reduceat(links, np.append(0, group_end[:-1]))
        long = np.flatnonzero(most > LISTED)
        links[np.flatnonzero(links > LISTED)] = 0
        g = np.repeat(np.arange(len(links)), links)
        t = np.arange(len(g)) - np.repeat(np.cumsum(links) - links, links)
        codes = (a[first_a[g] + t // of_b[g]] * self.width + b[first_b[g] + t % of_b[g]]).tobytes()
        code_end = (8 * np.cumsum(links)[group_end - 1]).tolist()
        n = np.diff(group_end, prepend=0).tolist()
        out = [(text[i:j], k, codes[p:q], b"") for i, j, k, p, q in
               zip([0, *text_end], text_end, n, [0, *code_end], code_end)]
        for w in long.tolist():
            out[w] = (*out[w][:2], *self._counted(out[w][0]))
        return out

    def _counted(self, text: str) -> tuple[bytes, bytes]:
        """Links of a window with long groups: each pair of a group once, and its times."""
        codes, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for group in text[:-1].split(";"):
            (u, n), (v, m) = (np.unique(np.array(side.split(","), np.int64), return_counts=True)
                              for side in group.split("|"))
            codes.append((u[:, None] * self.width + v).ravel())
            times.append((n[:, None] * m).ravel())
        return np.concatenate(codes).tobytes(), np.concatenate(times).tobytes()

    def remembered(self, keys: list[tuple[bytes, bytes]]) -> list[tuple]:
        """Alignments of distinct windows, computed together where not remembered; long windows are not kept."""
        found = [self.windows.get(k) or self.older.get(k) for k in keys]
        new = [i for i, hit in enumerate(found) if hit is None]
        for i, result in zip(new, self.aligned([keys[i] for i in new]) if new else ()):
            found[i] = result
        if len(self.windows) > WINDOWS // 2:
            self.windows, self.older = {}, self.windows
        self.windows.update((k, v) for k, v in islice(zip(keys, found), WINDOWS // 2)
                            if len(k[0]) + len(k[1]) <= 4 * LONGEST)
        return found

    def align(self, documents: list[tuple[bytes, bytes]]) -> list[tuple[int, int, str, np.ndarray, np.ndarray]]:
        """Per document: groups, links, the groups' checksum, the distinct pairs and the times of each."""
        if not documents:
            return []
        ids = [np.frombuffer(b"".join([d[i] for d in documents]), "<u4") for i in (0, 1)]
        docs = [np.cumsum([0] + [len(d[i]) // 4 for d in documents[:-1]]) for i in (0, 1)]
        begin = self.windows_of(*ids, *docs)
        n = len(begin[0])
        counts = [np.diff(at, append=len(x)) for at, x in zip(begin, ids)]
        own = [np.repeat(np.arange(n), c) for c in counts]
        place = [np.arange(len(x)) - at[w] for x, at, w in zip(ids, begin, own)]
        hashes = np.zeros(n, dtype=U)
        for x, at, p, salt in zip(ids, begin, place, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
            hashes += np.add.reduceat(mix((p.astype(U) << U(32) | x) * U(salt)), at)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        # equal hashes must be equal ids; a window that is not like its first one counts apart
        like, other = first[which], np.zeros(n, dtype=bool)
        for x, at, w, p, c in zip(ids, begin, own, place, counts):
            other |= c != c[like]
            far = np.minimum(at[like][w] + p, len(x) - 1)
            other[w[x != x[far]]] = True
        apart = np.flatnonzero(other)
        which[apart] = len(first) + np.arange(len(apart))
        first = np.concatenate([first, apart])
        spans = [(4 * at[first]).tolist() for at in begin] + [(4 * (at + c)[first]).tolist() for at, c in zip(begin, counts)]
        raw = [x.tobytes() for x in ids]
        known = self.remembered([(raw[0][i:j], raw[1][k:m]) for i, k, j, m in zip(*spans)])

        # every window's text and links, from those of the distinct ones
        text, groups, codes, times = zip(*known)
        shown = np.frombuffer("".join(text).encode(), np.uint8)
        text_ends, text = _gathered(shown, np.array([len(t) for t in text]), which)
        pairs = np.frombuffer(b"".join(codes), np.int64)
        sizes = np.array([len(c) // 8 for c in codes])
        ends, pairs = _gathered(pairs, sizes, which)
        ones = b"\x01" + bytes(7)
        weight = None
        if any(times):
            flat = b"".join([t or ones * k for k, t in zip(sizes.tolist(), times)])
            weight = _gathered(np.frombuffer(flat, np.int64), sizes, which)[1]
        last = np.searchsorted(begin[0], np.append(docs[0][1:], len(ids[0]))) - 1
        text_ends, ends = text_ends[last].tolist(), ends[last]
        n_groups = np.diff(np.cumsum(np.array(groups)[which])[last], prepend=0).tolist()
        # distinct pairs per document
        row = np.repeat(np.arange(len(documents)), np.diff(ends, prepend=0))
        key = row << 40 | pairs
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        many = np.diff(new, append=len(key)) if weight is None else np.add.reduceat(weight[order], new)
        cuts = np.searchsorted(key[new] >> 40, np.arange(len(documents) + 1)).tolist()
        pair = key[new] & ((1 << 40) - 1)
        text = text.tobytes()
        return [(g, int(many[i:j].sum()), hashlib.sha256(text[s:e - 1]).hexdigest(), pair[i:j], many[i:j])
                for g, i, j, s, e in zip(n_groups, cuts, cuts[1:], [0, *text_ends], text_ends)]


def _gathered(flat: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of ``flat`` (of the given sizes, end to end) picked by ``which``: where each ends, and all of them."""
    begin, size = (np.cumsum(sizes) - sizes)[which], sizes[which]
    ends = np.cumsum(size)
    small = np.int32 if max(len(flat), ends[-1]) < 1 << 31 else np.int64
    at = np.repeat((begin - (ends - size)).astype(small), size)
    at += np.arange(ends[-1], dtype=small)
    return ends, flat[at]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner for two vocabulary files."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *values])))


def _aligned(path_a: str, path_b: str):
    none = np.zeros(0, np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        for part, ids in ((p, x) for b in batches for whole in by_bytes(b, 2, BATCH_BYTES)
                          for p, x in both.parts(whole)):
            found = iter(both.align([x for x in ids if x]))
            rows = [(len(x[0]) // 4, len(x[1]) // 4, *next(found)) if x else (0, 0, 0, 0, "", none, none) for x in ids]
            n_a, n_b, n_groups, n_links, digest, pairs, times = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)],
                 pa.array(digest, pa.string()), _lists(pairs), _lists(times)],
                names=["row", *_COLUMNS, "pairs", "times"])
    return run


def aligned_pairs(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A written row per document: token and group numbers, and its distinct linked pairs.

    A pair is one number, ``id_a * (size of vocabulary b) + id_b``; ``times``
    are its links in the document.
    """
    spark = docs.sparkSession
    attach(spark)
    path = scratch_path(spark, "aligned")
    (docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
     .mapInArrow(_aligned(path_a, path_b), HELD).write.option("compression", "zstd").parquet(path))
    return spark.read.schema(HELD).parquet(path)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``(pair, n, best)``: documents that hold a pair; whether no other pair of its first id is in more."""
    counts = save(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
                  .withColumn("id_a", F.expr(f"pair div {width}")), "pair-counts")
    most = counts.groupBy("id_a").agg(F.max("n").alias("most"))
    return counts.join(most, "id_a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _looked_up(table):
    """Per document, its links that are best ones and the sum of their pairs' counts, within one block."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = table.value
        for batch in batches:
            lists = batch.column(7)
            ends = lists.offsets.to_numpy().astype(np.int64)
            pairs, times = (batch.column(i).flatten().to_numpy() for i in (7, 8))
            at = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
            there = times * (known[at] == pairs)
            sums = [np.concatenate([[0], np.cumsum(x)])[ends - ends[0]] for x in (there * best[at], there * n[at])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:7], *[pa.array(np.diff(s), pa.int64()) for s in sums]],
                names=["row", *_COLUMNS, "n_best", "count_sum"])
    return run


def align_documents(docs: DataFrame, path_a: str, path_b: str, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` per document.

    ``path_a`` is a byte-level vocabulary of the tokenizers library, given a
    space and the text; ``path_b`` a sentencepiece model, given the text (it
    adds the space).  Places where both have a token end cut a document into
    groups, and all pairs within a group are links.  Texts that are null,
    empty, or not given back byte by byte by both have no tokens: zeros and an
    empty ``groups_sha256``.  Rows that repeat are documents of their own; no
    documents give no rows.
    """
    import sentencepiece

    spark = docs.sparkSession
    width = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    aligned = aligned_pairs(docs, path_a, path_b)
    counts = save(pair_counts(aligned, width), "pairs")
    blocks = max(1, -(-counts.count() // block_pairs))
    path = scratch_path(spark, "alignments")
    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, " \
             "n_best long, count_sum long"
    for b in range(blocks):
        mine = counts if blocks == 1 else counts.filter(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == b)
        held = mine.toArrow()
        pair = held.column("pair").to_numpy()
        order = np.argsort(pair)
        if not len(pair):
            # a pair that no document has keeps the look-up total
            pair, order = np.array([-1]), np.array([0])
        n = held.column("n").to_numpy()[order] if len(held) else np.zeros(1, np.int64)
        best = held.column("best").to_numpy(zero_copy_only=False)[order] if len(held) else np.zeros(1, bool)
        table = spark.sparkContext.broadcast((pair[order], n, best))
        aligned.mapInArrow(_looked_up(table), schema).write.mode("append").parquet(path)
        table.destroy()
    out = spark.read.schema(schema).parquet(path)
    if blocks > 1:
        same = [F.first(c).alias(c) for c in _COLUMNS]
        out = out.groupBy("row").agg(*same, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
