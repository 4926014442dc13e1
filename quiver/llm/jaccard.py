"""Near-duplicate classes by an exact n-gram Jaccard join.

A document's set are its distinct five-word shingles (64-bit hashes).  Two
sets link when their Jaccard similarity reaches the threshold.

1. Equal sets are one class.  An exchange of packed hashes tells which
   shingles of a class occur in another class; a class that shares less than
   the least overlap a link needs has no link.  Most of a corpus ends here.
2. Contraction: classes with an equal minimum hash are compared in bounded
   groups (one with the most central member in each, where a group is cut),
   which finds nearly all links and joins families of copies.
3. Adaptive multi-match prefixes settle the rest exactly.  Shingles are
   ordered by document frequency, rarest first.  Of a set of n with least
   overlap c, any linked pair shares l shingles within the first n - c + l of
   both.  A document whose prefix of l = 1 meets many candidates gets a larger
   l, so that its partners must match several times before they are verified;
   a pair needs the smaller l of the two.  Only shingles whose postings span
   several components of step 2 are used, and only pairs across them.
4. Postings too long to be listed as pairs are compared family by family, in
   pairs of blocks, by a matrix product of their sets.

Components come from the links of steps 2 to 4; each verified link was
computed on whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import attach
from .components import components
from .exchange import bucket_count, shared_places
from .hashing import U, by_bytes, mix, places, window_hashes, word_hashes
from .shared import TEXT_BATCH, boxed, save, small_side, unboxed

WORDS = 5
PERCENT = 75
# members of a block that one task compares with another block
BLOCK = 512
# postings up to this length are listed as pairs
LISTED = 128
ROUNDS = 2
# text whose shingles one task compares: about four bytes of shingles a byte
BUCKET_BYTES = 8 << 20
# estimated candidates per doubling of which a document's prefix grows by one match
COST_UNIT = 64


def shingles(texts: pa.Array, width: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: row, hash and first place, in row order.

    A-Z count as a-z.  A text of fewer words has its whole sequence as one
    shingle, one without words has none.
    """
    words, counts = word_hashes(texts, lower=True)
    row, place, left = places(counts)
    hashes = window_hashes(words, width)
    pick = left >= width
    for k in range(1, width):
        short = (counts[row] == k) & (place == 0)
        if short.any():
            hashes = np.where(short, window_hashes(words, k), hashes)
            pick |= short
    row, place, hashes = row[pick], place[pick], hashes[pick]
    _, first = np.unique(mix(hashes ^ (row.astype(U) * U(0x9E3779B97F4A7C15))), return_index=True)
    first.sort()
    return row[first], hashes[first], place[first]


def ordered_shingles(texts: pa.Array, width: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: row, hash and rank by hash, in this order.

    Equal sets have equal ranks, in whatever order their texts hold them.
    """
    row, hashes, _ = shingles(texts, width)
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    return row, hashes, np.arange(len(row)) - np.searchsorted(row, row)


def _set_keys(rows: int, row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each set's size and a 64-bit hash of its members in any order."""
    sizes = np.bincount(row, minlength=rows)
    total = np.concatenate([np.zeros(1, U), np.cumsum(mix(hashes + U(0x5851F42D4C957F2D)))])
    ends = np.cumsum(sizes)
    sums = total[ends] - total[ends - sizes]
    return sizes, mix(sums + sizes.astype(U)).view(np.int64)


def _keyed(width: int):
    def run(batches):
        for batch in (part for whole in batches for part in by_bytes(whole, 2)):
            row, hashes, _ = shingles(batch.column(2), width)
            sizes, keys = _set_keys(batch.num_rows, row, hashes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64())],
                names=["doc_id", "fp", "n", "set"])
    return run


def _entries(width: int):
    def run(batch: pa.RecordBatch):
        row, hashes, place = ordered_shingles(batch.column(0), width)
        return _set_keys(batch.num_rows, row, hashes)[1], row, hashes, place
    return run


def _shared_sets(width: int):
    """The shingles of a text at given ranks of its set."""
    def run(batches):
        for batch in (part for whole in batches for part in by_bytes(whole, 1)):
            row, hashes, place = ordered_shingles(batch.column(1), width)
            marks = batch.column(2)
            at = marks.flatten().to_numpy().astype(np.int64)
            of = np.repeat(np.arange(batch.num_rows), np.diff(marks.offsets.to_numpy()))
            keep = np.isin(row.astype(np.int64) << 40 | place, of << 40 | at)
            counts = np.bincount(row[keep], minlength=batch.num_rows)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes[keep].view(np.int64)))],
                names=["id", "tokens"])
    return run


def overlaps(owner: np.ndarray, tokens: np.ndarray, members: int) -> np.ndarray:
    """Intersection sizes of all pairs of a few sets, by blocks of a 0/1 matrix product."""
    uniq, column, times = np.unique(tokens, return_inverse=True, return_counts=True)
    often = times > 1
    column = (np.cumsum(often) - 1)[column]
    keep = np.repeat(True, len(tokens)) if not len(tokens) else often[np.searchsorted(uniq, tokens)]
    owner, column = owner[keep], column[keep]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((members, members), dtype=np.float32)
    step = 4096
    for lo in range(0, int(often.sum()), step):
        a, b = np.searchsorted(column, [lo, lo + step])
        block = np.zeros((members, step), dtype=np.float32)
        block[owner[a:b], column[a:b] - lo] = 1
        out += block @ block.T
    return out


def _forest(linked: np.ndarray) -> np.ndarray:
    """The root (smallest member) of each member under a symmetric link matrix."""
    root = np.full(len(linked), -1)
    for start in range(len(linked)):
        if root[start] >= 0:
            continue
        root[start] = start
        front = [start]
        while front:
            new = np.flatnonzero(linked[front].any(axis=0) & (root < 0))
            root[new] = start
            front = new.tolist()
    return root


def _links(percent: int):
    """Links that join the members of a group, one per member that is not a root."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, n = table.column("id").to_numpy(), table.column("n").to_numpy()
        lists = table.column("tokens").combine_chunks()
        owner = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
        both = overlaps(owner, lists.flatten().to_numpy(), len(ids))
        root = _forest(100 * both >= percent * (n[:, None] + n[None, :] - both))
        end = root != np.arange(len(ids))
        return pa.table({"u": pa.array(ids[end], pa.int64()), "v": pa.array(ids[root[end]], pa.int64())})
    return run


def _contract(sets: DataFrame, percent: int) -> DataFrame:
    """Verified links between classes that agree in a minimum hash."""
    keys = F.array(*[F.array_min(F.transform("tokens", lambda t, r=r: F.xxhash64(t, F.lit(r))))
                     for r in range(ROUNDS)])
    keyed = sets.select("id", "n", "centre", F.posexplode(keys).alias("r", "k"))
    groups = save(keyed.groupBy("r", "k").agg(F.count(F.lit(1)).alias("m"),
                                              F.max_by("id", F.struct("centre", "id")).alias("hub"))
                  .filter("m > 1"), "contract-groups")
    cuts = F.when(F.col("m") <= BLOCK, 1).otherwise(F.ceil(F.col("m") / F.lit(BLOCK // 2))).cast("int")
    own = F.pmod(F.xxhash64("id", "k"), cuts).cast("int")
    dealt = (keyed.join(small_side(groups, 40), ["r", "k"])
             .withColumn("part", F.explode(F.when(F.col("id") == F.col("hub"), F.sequence(F.lit(0), cuts - 1))
                                           .otherwise(F.array(own)))))
    return (dealt.select("id", "r", "k", "part").join(sets.select("id", "n", "tokens"), "id")
            .groupBy("r", "k", "part").applyInArrow(_links(percent), "u long, v long"))


def _settle(sets: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Links between different components of ``known`` that prefixes can not rule out."""
    labels = small_side(components(known).select(F.col("node").alias("id"), "component"), 16)
    held = sets.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    cost = F.aggregate(F.slice("ranked", 1, F.size("ranked") - F.col("c") + 1), F.lit(0).cast("long"),
                       lambda s, x: s + x["df"] - 1)
    match = F.least(F.col("c"), (F.floor(F.log2(1 + cost / COST_UNIT)) + 1).cast("int"))
    prefix = (held.withColumn("l", match)
              .select("id", "n", "component", "l",
                      F.explode(F.slice("ranked", 1, F.size("ranked") - F.col("c") + F.col("l"))).alias("x"))
              .select("id", "n", "component", "l", F.col("x.token").alias("token")))
    prefix = save(prefix, "prefixes")
    spans = save(prefix.groupBy("token").agg(
        F.count(F.lit(1)).alias("m"), F.min("component").alias("lo"), F.max("component").alias("hi"),
        F.min("id").alias("head")).filter("lo <> hi").select("token", "m", "head"), "spans")
    if spans.isEmpty():
        return known.limit(0)
    open_ = save(prefix.join(small_side(spans, 32), "token"), "open-postings")

    few = open_.filter(F.col("m") <= LISTED).select("token", "id", "n", "component", "l")
    a, b = few.alias("a"), few.alias("b")
    pairs = (a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.id") < F.col("b.id"))
                    & (F.col("a.component") != F.col("b.component"))
                    & (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n")))
             .groupBy(F.col("a.id").alias("u"), F.col("b.id").alias("v"))
             .agg(F.count(F.lit(1)).alias("met"), F.first(F.least("a.l", "b.l")).alias("need"),
                  F.first("a.n").alias("nu"), F.first("b.n").alias("nv"))
             .filter("met >= need").select("u", "v", "nu", "nv"))
    tokens = sets.select(F.col("id").alias("s"), "tokens")
    both = F.size(F.array_intersect("tu", "tv"))
    met = (save(pairs, "pairs").join(tokens.withColumnRenamed("tokens", "tu"), F.col("u") == F.col("s")).drop("s")
           .join(tokens.withColumnRenamed("tokens", "tv"), F.col("v") == F.col("s"))
           .filter(100 * both >= percent * (F.col("nu") + F.col("nv") - both)).select("u", "v"))

    many = save(open_.filter(F.col("m") > LISTED).select("id", "head").distinct(), "long-postings")
    if many.isEmpty():
        return met
    family = save(components(many.select(F.col("id").alias("u"), F.col("head").alias("v")))
                  .withColumnRenamed("component", "family"), "families")
    sizes = family.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    met_blocks = (family.join(small_side(save(sizes, "family-sizes"), 16), "family").withColumn("b", block)
                  .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                  .select("family", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"),
                          F.col("node").alias("id"))
                  .join(sets.select("id", "n", "tokens"), "id")
                  .groupBy("family", "i", "j").applyInArrow(_links(percent), "u long, v long"))
    return met.unionByName(met_blocks)


def link_documents(docs: DataFrame, percent: int = PERCENT, width: int = WORDS) -> DataFrame:
    """``(doc_id, fp, n_shingles, component_id)``, a row for each document.

    ``component_id`` is the smallest document id reachable by links of
    ``100 * intersection >= percent * union``.  Null texts and texts without
    words have an empty set and are components of their own, even if there
    are several.  Rows with equal sets always link.  A null id is never the
    smallest, so a component without any other id has none.  ``fp`` is a hash
    of the text.
    """
    attach(docs.sparkSession)
    keyed = save(docs.select("doc_id", F.xxhash64("text").alias("fp"), "text")
                 .mapInArrow(_keyed(width), "doc_id long, fp long, n long, set long"), "sets", TEXT_BATCH)
    classes = save(keyed.filter("n > 0").groupBy("set").agg(
        F.first("n").alias("n"), F.min("doc_id").alias("smallest"),
        F.min(F.struct("doc_id", "fp")).alias("pick")), "classes")
    least = F.ceil(F.col("n") * percent / 100).cast("int")

    shared = shared_places(docs.select("text"), _entries(width), bucket_count(docs, BUCKET_BYTES), False, False)
    alive = save(shared.withColumnRenamed("key", "set").join(classes, "set")
                 .filter(F.size("places") >= least)
                 .select("set", "n", F.col("pick.doc_id").alias("p_id"), F.col("pick.fp").alias("p_fp"), "places"),
                 "candidates", TEXT_BATCH)
    wanted = small_side(alive.select("set", "p_id", "p_fp"), 32)
    texts = (docs.select("doc_id", F.xxhash64("text").alias("fp"), "text")
             .join(wanted, F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("fp") == F.col("p_fp")))
             .select("set", "text").join(alive.select("set", "places"), "set"))
    tokens = save(texts.select("set", "text", "places").mapInArrow(_shared_sets(width), "id long, tokens array<long>")
                  .groupBy("id").agg(F.first("tokens").alias("tokens")), "tokens", TEXT_BATCH)

    each = tokens.select("id", F.explode("tokens").alias("token"))
    frequent = each.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    ranked = (each.join(frequent, "token").groupBy("id")
              .agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("ranked"))
              .join(alive.select(F.col("set").alias("id"), "n"), "id").withColumn("c", least)
              .filter(F.size("ranked") >= F.col("c")))
    sets = save(ranked.select(
        "id", "n", "c", "ranked", F.transform("ranked", lambda x: x["token"]).alias("tokens"),
        (F.aggregate("ranked", F.lit(0).cast("long"), lambda s, x: s + x["df"]) / F.col("n")).alias("centre")),
        "ranked-sets")
    first = save(_contract(sets, percent), "contracted")
    links = save(first.unionByName(_settle(sets, first, percent)), "links")
    groups = (components(links).join(classes.select(F.col("set").alias("node"), "smallest"), "node"))
    smallest = groups.groupBy("component").agg(F.min("smallest").alias("component_id"))
    found = groups.join(smallest, "component").select(F.col("node").alias("set"), "component_id")
    named = save(classes.join(found, "set", "left")
                 .select(F.col("set").alias("s"), F.coalesce("component_id", "smallest").alias("component_id")),
                 "class-components")
    return (keyed.join(named, (F.col("set") == F.col("s")) & (F.col("n") > 0), "left")
            .select("doc_id", "fp", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def keep_one_of_each(docs: DataFrame, percent: int = PERCENT, width: int = WORDS) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id.

    Documents without words all stay (rows that repeat in id and text may
    become one where any such row has words).  Rows without an id stay, one for
    each text, unless their component has one with an id.
    """
    linked = save(link_documents(docs, percent, width), "linked")
    gone = (linked.filter(F.col("component_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias("g_id"), F.col("fp").alias("g_fp")).distinct())
    gone = save(gone, "near-duplicates")
    keyed = boxed(docs).withColumn("fp", F.xxhash64("v.text"))
    rest = keyed.join(small_side(gone, 24), F.col("v.doc_id").eqNullSafe(F.col("g_id"))
                      & (F.col("fp") == F.col("g_fp")), "left_anti")
    twice = linked.groupBy("doc_id", "fp").agg(F.count(F.lit(1)).alias("m"), F.max("n_shingles").alias("n")) \
        .filter("m > 1 AND n > 0")
    if not twice.isEmpty():
        rest = rest.withColumn("id", F.col("v.doc_id")).dropDuplicates(["id", "fp"])
    return unboxed(rest, docs.columns)
