"""Cross-site boilerplate lines.

A line that many sites carry is boilerplate.  The spread of a line is a
distinct count of sites, merged from HyperLogLog sketches by one aggregation
(a task sends one sketch per line, however often a site repeats it).  Only
lines whose estimate is near the threshold get an exact distinct count.  A
boilerplate line is removed from every document but the one with the smallest
id that carries it, so nothing is lost from the corpus altogether.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import boxed, quoted_name, save, small_side, unboxed

# 2^12 registers: a relative error of 1.6 %; up to some hundreds of sites the
# sketch keeps its entries one by one and is nearly exact
LG_K = 12
BLANK = " \t\x0b\x0c\r"
ERROR = 1.04 / 2 ** (LG_K / 2)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def boilerplate_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """``(h, holder)`` of lines on at least ``min_sites`` sites, from ``(h, site, doc_id)``.

    ``holder`` is the smallest document id with that line.  Null sites count
    as one site.
    """
    site = F.coalesce(F.col("site"), F.lit("\x00"))
    spread = save(lines.groupBy("h").agg(F.hll_sketch_agg(site, F.lit(LG_K)).alias("sketch"),
                                         F.min("doc_id").alias("holder"))
                  .select("h", "holder", F.hll_sketch_estimate("sketch").alias("sites"))
                  .filter(F.col("sites") >= F.lit(int(min_sites * (1 - 3 * ERROR)) - 1)), "line-spread")
    sure = F.col("sites") > F.lit(min_sites * (1 + 3 * ERROR) + 1)
    near = save(spread.filter(~sure), "line-near")
    exact = (lines.join(small_side(near.select("h"), 16), "h")
             .groupBy("h").agg(F.countDistinct(site).alias("sites")).filter(F.col("sites") >= min_sites))
    return save(spread.filter(sure).select("h", "holder")
                .unionByName(near.select("h", "holder").join(exact.select("h"), "h")), "line-boilerplate")


def dedup_lines(docs: DataFrame, min_sites: int = 10, site_col: str = "source") -> DataFrame:
    """All columns of ``docs`` with the text cleaned, plus ``n_lines`` and ``n_removed``.

    Lines end at a line feed and are compared without white space at their
    ends; blank lines are no lines: they stay and are not counted.  A null
    text stays null and has no lines.  Rows of one id and text are cleaned
    alike.  A document without an id never is a line's holder.  Columns
    called ``n_lines`` or ``n_removed`` are replaced.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    lines = (docs.select("doc_id", F.col(site_col).cast("string").alias("site"),
                         F.xxhash64("text").alias("fp"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
             .withColumn("line", F.btrim("line", F.lit(BLANK)))
             .filter(F.col("line") != "")
             .select("doc_id", "site", "fp", "pos", F.xxhash64("line").alias("h")))
    lines = save(lines, "line-hashes")
    known = small_side(boilerplate_lines(lines, min_sites), 24)
    held = F.col("holder").isNotNull() & F.col("doc_id").eqNullSafe(F.col("holder"))
    cut = (lines.join(known, "h").filter(~held).dropDuplicates(["doc_id", "fp", "pos"])
           .groupBy(F.col("doc_id").alias("c_id"), F.col("fp").alias("c_fp"))
           .agg(F.collect_list("pos").alias("cut")))
    cut = save(cut, "line-cuts")

    text = F.col("v.text")
    keyed = boxed(docs.select(*[F.col(quoted_name(c)) for c in columns])).withColumn("fp", F.xxhash64(text))
    joined = keyed.join(small_side(cut, 200), F.col("v.doc_id").eqNullSafe(F.col("c_id"))
                        & (F.col("fp") == F.col("c_fp")), "left")
    joined = joined.withColumn("parts", F.when(F.col("cut").isNotNull(), F.split(text, "\n")))
    # a set difference and look-ups by place: linear in the number of lines
    kept = F.transform(F.array_except(F.sequence(F.lit(1), F.size("parts")),
                                      F.transform("cut", lambda p: p + 1)),
                       lambda i: F.element_at(F.col("parts"), i))
    cleaned = F.when(F.col("cut").isNull(), text).otherwise(F.array_join(kept, "\n"))
    counted = F.size(F.filter(_lines(text), lambda x: F.btrim(x, F.lit(BLANK)) != ""))
    removed = F.when(F.col("cut").isNull(), 0).otherwise(F.size("cut"))
    return unboxed(joined, columns, text=cleaned, n_lines=counted.cast("long"), n_removed=removed.cast("long"))


def cleaned_documents(docs: DataFrame, min_sites: int = 10, site_col: str = "source") -> DataFrame:
    """``docs`` without boilerplate lines, in its own columns (``n_chars`` counted anew)."""
    own = {c: f"__own_{c}" for c in ("n_lines", "n_removed") if c in docs.columns}
    out = dedup_lines(docs.withColumnsRenamed(own), min_sites, site_col)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.select(*[F.col(quoted_name(own.get(c, c))).alias(c) for c in docs.columns])
