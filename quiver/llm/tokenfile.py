"""Token-id files: a wavelet matrix per shard, written and read through Spark.

Documents are ordered by id over range partitions.  A task encodes its range
as a stream and closes a shard whenever it holds enough ids, so its memory is
bounded by a shard (and one document).  Shards are rows of compressed Parquet
files, each with a complete file image: Spark's commit protocol makes a retry
harmless, and any store Spark reaches will do.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.session import attach, scratch_path
from . import wavelet
from .encode import BATCH_BYTES, ID, crc, encoder, with_ends
from .hashing import by_bytes
from .shared import small_side

SHARD_IDS = 1 << 20
SHARD_SCHEMA = "part long, seq long, n_ids long, n_docs long, image binary"
DIGEST_SCHEMA = "part long, seq long, doc_id long, before long, n_tokens long, ids_crc32 long"


def _write(path: str, end_id: int, bits: int, shard_ids: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        part, seq = TaskContext.get().partitionId(), 0
        held, parts = 0, []          # parts: ids, document ids, which of these are null, lengths

        def shard() -> pa.RecordBatch:
            ids, docs, nulls, lengths = (np.concatenate(x) for x in zip(*parts))
            image = wavelet.build(ids, docs, nulls, lengths, bits)
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in ((part, pa.int64()), (seq, pa.int64()), (len(ids), pa.int64()),
                                               (len(docs), pa.int64()), (image, pa.binary()))],
                names=["part", "seq", "n_ids", "n_docs", "image"])

        for rows in (p for batch in batches for p in by_bytes(batch, 1, BATCH_BYTES)):
            doc = rows.column(0)
            docs, nulls = pc.fill_null(doc, 0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False)
            ids, ends = with_ends(*encode.many(rows.column(1)), end_id)
            lengths, lo = np.diff(ends, prepend=0), 0
            while lo < len(docs):
                # up to the document that fills the shard
                before = ends[lo] - lengths[lo]
                hi = min(len(docs), int(np.searchsorted(ends, before + shard_ids - held)) + 1)
                parts.append((ids[before:ends[hi - 1]], docs[lo:hi], nulls[lo:hi], lengths[lo:hi]))
                held += int(ends[hi - 1] - before)
                if held >= shard_ids:
                    yield shard()
                    held, parts, seq = 0, [], seq + 1
                lo = hi
        if parts:
            yield shard()
    return run


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int, bits: int = 16,
                      shard_ids: int = SHARD_IDS, path: str | None = None) -> str:
    """Encode all documents in ascending ``doc_id`` order; returns the folder.

    Null ids come first, and documents of one id in the order of their text's
    hash.  A null or empty text has the end id only.  No documents give a
    folder without shards.
    """
    spark = docs.sparkSession
    attach(spark)
    path = path or scratch_path(spark, "token-files")
    order = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    (docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
     .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
     .mapInArrow(_write(vocabulary, end_id, bits, shard_ids), SHARD_SCHEMA)
     .write.option("compression", "zstd").parquet(path))
    return path


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards of a folder with the number of ids before each: ``start``."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    sizes = shards.select("part", "seq", "n_ids")
    earlier = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    starts = (sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
              .join(offset, "part")
              .select("part", "seq", (F.col("offset") + F.col("inside")).alias("start")))
    return shards, small_side(starts, 32)


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, seq, image in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            shard = wavelet.Shard(image.as_py())
            ids = shard.decode().astype(ID).tobytes()
            lengths = shard.lengths.astype(np.int64)
            ends = np.cumsum(lengths)
            sums = [crc(ids[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
            rows = len(lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(rows, part), pa.int64()), pa.array(np.full(rows, seq), pa.int64()),
                 pa.array(shard.doc_ids, pa.int64(), mask=shard.null_ids != 0),
                 pa.array(ends - lengths, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.array(sums, pa.int64())],
                names=["part", "seq", "doc_id", "before", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, read back from the files: its place, length and checksum."""
    attach(spark)
    shards, starts = read_shards(spark, path)
    digests = shards.select("part", "seq", "image").mapInArrow(_digest, DIGEST_SCHEMA)
    return (digests.join(starts, ["part", "seq"])
            .select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))


def _counts(symbols: list[int]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for image in batch.column(0):
                shard = wavelet.Shard(image.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(symbols, pa.int64()), pa.array([shard.count(s) for s in symbols], pa.int64())],
                    names=["id", "n"])
    return run


def token_counts(spark: SparkSession, path: str, symbols: list[int]) -> DataFrame:
    """``(id, n)``: occurrences of given ids, by rank queries alone."""
    attach(spark)
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path).select("image")
    return shards.mapInArrow(_counts(symbols), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
