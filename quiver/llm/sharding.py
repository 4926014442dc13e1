"""Uniform sharding by a hypergeometric communication matrix.

A uniform shuffle of all rows into shards of fixed sizes can be drawn in two
steps: first *how many* rows go from every input partition to every shard (a
matrix with fixed row and column sums, drawn exactly from the multivariate
hypergeometric law), then *which* (a random permutation inside each input
partition, cut by its matrix row).  After the exchange each shard is permuted
once more.  Sizes are exact by construction: no shard is found to be over or
under after the fact, and rows move once.

The local permutation needs no shuffle: rows are sorted by a seeded hash
inside their partition and numbered there.  The second permutation runs in
hash ranges of each shard, so that no task holds a whole shard.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import power_of_two, quoted_name, save, small_side

# rows of a hash range of a shard that one task sorts, and ranges at least
ROWS_PER_RANGE = 500_000
MIN_RANGES = 1024
# numpy's own sampler refuses larger urns
URN = 10 ** 9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """One exact draw; above numpy's urn limit by inversion around the mode.

    The inverted window spans 12 standard deviations on both sides, so the
    mass left out is below 1e-30.
    """
    if draws == 0 or good == 0:
        return 0
    if bad == 0:
        return draws
    if good + bad < URN:
        return int(rng.hypergeometric(good, bad, draws))
    total = good + bad
    mean = draws * good / total
    sd = math.sqrt(max(mean * (bad / total) * (total - draws) / (total - 1), 0.0))
    lo = max(0, draws - bad, int(mean - 12 * sd) - 12)
    hi = min(draws, good, int(mean + 12 * sd) + 12)
    k = np.arange(lo, hi, dtype=np.float64)
    ratio = ((good - k) / (k + 1)) * ((draws - k) / (bad - draws + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(np.log(ratio))])
    mass = np.cumsum(np.exp(logs - logs.max()))
    return lo + int(np.searchsorted(mass, rng.random() * mass[-1], side="right"))


def communication_matrix(rows: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows to send from each partition to each shard.

    Every row sums to its partition's size, and the columns to the shard
    sizes, which are as equal as they can be (at most one apart).
    """
    total = sum(rows)
    rng = np.random.Generator(np.random.PCG64(seed))
    room = [total // shards + (j < total % shards) for j in range(shards)]
    out = []
    for n in rows:
        left, rest, line = n, sum(room), []
        for j in range(shards):
            rest -= room[j]
            take = hypergeometric(rng, room[j], rest, left)
            line.append(take)
            left -= take
        room = [r - t for r, t in zip(room, line)]
        out.append(line)
    return out


def shard_rows(df: DataFrame, shards: int, seed: int = 1, shard_col: str = "shard",
               slot_col: str = "slot") -> DataFrame:
    """All columns of ``df`` plus the shard and the gapless slot in it.

    Shard sizes differ by one at most, and every assignment of rows to shard
    places is equally likely over seeds.  Rows may repeat, hold nulls or be
    absent altogether (an empty input gives an empty result); a column of
    ``df`` that has one of the new columns' names is replaced.
    """
    if shards < 1:
        raise ValueError(f"shards must be positive, got {shards!r}")
    columns = [c for c in df.columns if c not in (shard_col, slot_col)]
    # maps have no hash of their own
    kinds = {f.name: f.dataType for f in df.schema.fields}
    inner = [F.col(f"v.{quoted_name(c)}") for c in columns]
    seeded = F.xxhash64(F.lit(seed), *[F.to_json(F.struct(x)) if "map<" in kinds[c].simpleString() else x
                                       for c, x in zip(columns, inner)])
    held = df.select(F.struct(*[F.col(quoted_name(c)) for c in columns]).alias("v"))
    local = F.monotonically_increasing_id()
    drawn = save(held.sortWithinPartitions(seeded)
                 .select("v", F.shiftright(local, 33).cast("int").alias("p"),
                         local.bitwiseAND(F.lit((1 << 33) - 1)).alias("r")), "shard-rows")

    spark = df.sparkSession
    sizes = drawn.groupBy("p").agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
    matrix = communication_matrix([x["n"] for x in sizes], shards, seed)
    ends = spark.createDataFrame(
        [(x["p"], [int(e) for e in np.cumsum(line)]) for x, line in zip(sizes, matrix)],
        "p int, ends array<long>")
    total = sum(x["n"] for x in sizes)
    ranges = power_of_two(max(MIN_RANGES / shards, total / shards / ROWS_PER_RANGE))

    order = F.xxhash64(F.lit(seed + 1), "p", "r")
    dealt = (drawn.join(small_side(ends, 8 * shards + 16, len(sizes)), "p")
             .withColumn("s", F.size(F.filter("ends", lambda e: e <= F.col("r"))))
             .select("v", "p", "r", "s", order.alias("o"),
                     (F.shiftrightunsigned(order, 64 - int(math.log2(ranges))) if ranges > 1
                      else F.lit(0).cast("long")).alias("g")))
    before = Window.partitionBy("s").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy("s", "g").agg(F.count(F.lit(1)).alias("n"))
              .select("s", "g", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    within = Window.partitionBy("s", "g").orderBy("o", "p", "r")
    return (dealt.withColumn("i", F.row_number().over(within) - 1)
            .join(small_side(starts, 32, shards * ranges), ["s", "g"])
            .select(*[F.col(f"v.{quoted_name(c)}").alias(c) for c in columns], F.col("s").alias(shard_col),
                    (F.col("start") + F.col("i")).cast("long").alias(slot_col)))


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 1) -> DataFrame:
    """The law ``rows``: a uniform shuffle of all documents, counts at most one apart.

    ``size`` is the UTF-8 length of the text plus 1 (null text: 1), and
    ``text_crc32`` that of its bytes (null text: 0, as of no bytes).
    """
    narrow = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    return (shard_rows(narrow, shards, seed)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
