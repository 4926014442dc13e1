"""Mixing sources to target weights.

Every source gets a token budget from its weight; a hash-random order of its
documents is cut exactly at that budget, and a source whose budget exceeds its
size is repeated in whole epochs first.  No source passes through one task:
documents are dealt into hash ranges of their source, each range is summed,
the sums of earlier ranges give where a range begins, and the running sum
inside a range gives every document its interval.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import boxed, power_of_two, save, unboxed, word_count

KEY_BITS = 60
ROWS_PER_RANGE = 200_000
MIN_RANGES = 64


def source_targets(sizes: DataFrame, cap: int = 3) -> DataFrame:
    """``(source, source_size, target, budget)`` from ``(source, source_size)``.

    Sources by code point (null last) weigh 1, 2, 3, 1, 2, 3 ... and share
    the sum of all sizes; a target stops at ``cap`` times its source's size
    and the excess is shared anew by weight.  With sources in the order of
    size per weight this is one pass: source k is capped exactly if its cap
    is no more than its share of what the sources before it have left.
    One row per source goes through these windows, not documents.
    """
    every = Window.partitionBy()
    ranked = sizes.withColumn("w", ((F.row_number().over(Window.orderBy(
        F.col("source").asc_nulls_last())) - 1) % 3 + 1).cast("long"))
    ranked = ranked.withColumn("full", F.col("source_size") * F.lit(cap))
    before = (Window.orderBy((F.col("full") / F.col("w")).asc(), F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(before), F.lit(0))
    weight = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))
    shared = (ranked.withColumn("share", left.cast("double") / weight.cast("double"))
              .withColumn("capped", F.col("full") <= F.col("share") * F.col("w")))
    rate = F.max(F.when(~F.col("capped"), F.col("share"))).over(every)
    target = F.when(F.col("capped"), F.col("full").cast("double")).otherwise(rate * F.col("w"))
    return (shared.withColumn("target", target)
            .select("source", "source_size", "target",
                    F.floor(F.col("target") + 0.5).cast("long").alias("budget")))


def mix_sources(docs: DataFrame, cap: int = 3, seed: str = "mix") -> DataFrame:
    """What the mix takes of every document.

    ``(doc_id, source, fp, size, source_size, target, taken)``, a row for
    each input row; ``fp`` is a hash of the text.  ``taken`` counts words: of
    each source they add up to its target, rounded; at the cut a document is
    taken in part.  The order of documents depends on ``doc_id``, ``source``
    and ``seed`` only, so reruns agree.  Texts that are null or have no word
    have size 0 and nothing taken; a null source is a source; rows that agree
    in all of this count as that many copies in a row.
    """
    key = F.conv(F.substring(F.md5(F.concat_ws(
        "|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.coalesce("source", F.lit("")))), 1, KEY_BITS // 4), 16, 10).cast("long")
    rows = save(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                            F.xxhash64("text").alias("fp"))
                .groupBy("doc_id", "source", "size", "fp").agg(F.count(F.lit(1)).alias("copies"))
                .withColumn("k", key), "mix-rows")
    ranges = power_of_two(max(MIN_RANGES, rows.count() / ROWS_PER_RANGE))
    rows = (rows.withColumn("g", F.shiftright("k", KEY_BITS - (ranges.bit_length() - 1)))
            .withColumn("words", F.col("size") * F.col("copies")))

    sums = save(rows.groupBy("source", "g").agg(F.sum("words").alias("words")), "mix-sums")
    earlier = Window.partitionBy("source").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("s2"), F.col("g").alias("g2"),
                         F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"))
    targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), cap) \
        .withColumnRenamed("source", "s3")
    within = (Window.partitionBy("source", "g").orderBy("k", "doc_id", "size", "fp")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (rows.withColumn("run", F.coalesce(F.sum("words").over(within), F.lit(0)))
              .join(starts, F.col("source").eqNullSafe(F.col("s2")) & (F.col("g") == F.col("g2")))
              .join(targets, F.col("source").eqNullSafe(F.col("s3")))
              .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))))
    first = F.col("start") + F.col("run") + F.col("copy") * F.col("size")
    epochs = F.when(F.col("source_size") > 0,
                    F.floor(F.col("budget") / F.col("source_size"))).otherwise(0)
    cut = F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("first")
    return (placed.withColumn("first", first).withColumn("epochs", epochs)
            .select("doc_id", "source", "fp", "size", "source_size", "target",
                    (F.col("epochs") * F.col("size")
                     + F.greatest(F.lit(0), F.least(F.col("size"), cut))).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, cap: int = 3, seed: str = "mix") -> DataFrame:
    """The mix itself: every document as often as the mix repeats it.

    Columns as in ``docs``.  A document at a source's cut appears once with
    the words up to the cut (``n_chars``, where there is such a column, is
    counted anew).  Documents of which nothing is taken are left out, as are
    those without a word.
    """
    taken = save(mix_sources(docs, cap, seed)
                 .groupBy("doc_id", "source", "fp", "size").agg(
                     F.count(F.lit(1)).alias("rows"),
                     F.filter(F.collect_list("taken"), lambda t: t > 0).alias("t"))
                 .filter(F.size("t") > 0)
                 .select(*[F.col(c).alias(f"m_{c}") for c in ("doc_id", "source", "fp", "size", "rows", "t")]),
                 "mix-taken")
    keyed = boxed(docs).withColumn("fp", F.xxhash64("v.text"))
    same = (F.col("v.doc_id").eqNullSafe(F.col("m_doc_id"))
            & F.col("v.source").eqNullSafe(F.col("m_source")) & (F.col("fp") == F.col("m_fp")))
    once = keyed.join(taken.filter("m_rows = 1"), same)
    several = taken.filter("m_rows > 1")
    if not several.isEmpty():
        # rows alike in id, source and text share what the mix takes of them
        once = once.unionByName(keyed.join(several, same).dropDuplicates(["m_doc_id", "m_source", "m_fp"]))
    one = once.withColumn("m_t", F.explode("m_t"))
    whole = F.floor(F.col("m_t") / F.col("m_size")).cast("int")
    rest = F.col("m_t") - whole * F.col("m_size")
    parts = F.concat(F.array_repeat(F.col("m_size"), whole),
                     F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    out = one.withColumn("words", F.explode(parts))
    # parts end where a word ends, so they join to the text's beginning as it is
    ends = F.split(F.col("v.text"), "(?<=[^\\x20\\x09-\\x0D])(?=[\\x20\\x09-\\x0D])")
    head = F.array_join(F.slice(ends, F.lit(1), F.greatest(F.col("words"), F.lit(1)).cast("int")), "")
    cut = F.col("words") < F.col("m_size")
    new = {"text": F.when(cut, head).otherwise(F.col("v.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(cut, F.length(head).cast("long")).otherwise(F.col("v.n_chars"))
    return unboxed(out, docs.columns, **new)
