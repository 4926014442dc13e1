"""What several operators need: written intermediate tables, size checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.session import attach, scratch_path

# the largest side that is ever broadcast, in rows and bytes (both checked)
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 * 1024 * 1024

BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
# bytes of an Arrow batch of texts, as many as are hashed together
TEXT_BATCH = 4 << 20

# ASCII white space as the contracts define it
WORD = "[^\\x20\\x09-\\x0D]+"


def save(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs only the tasks that read from it.
    While it is written, the Arrow batches of Python functions hold about
    ``batch_bytes`` or one row (where the session has no bound of its own):
    by rows alone, a batch grows with the length of the texts, in the task's
    JVM and in its Python worker.
    """
    spark = df.sparkSession
    attach(spark)
    path = scratch_path(spark, name)
    schema = df.schema
    bound = batch_bytes is not None and BATCH_CONF not in spark.conf.getAll
    if bound:
        spark.conf.set(BATCH_CONF, batch_bytes)
    try:
        df.write.parquet(path)
    finally:
        if bound:
            spark.conf.unset(BATCH_CONF)
    return spark.read.schema(schema).parquet(path)


def small_side(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """Mark a saved table for broadcast when its counted size is within the bound."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS and n * row_bytes <= BROADCAST_BYTES else df


def word_count(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def power_of_two(n: float) -> int:
    """The smallest power of two that is at least ``n`` (1 at least)."""
    return 1 << max(0, int(-(-n // 1)) - 1).bit_length()


def quoted_name(name: str) -> str:
    """A column name in back quotes, its own back quotes doubled."""
    return "`" + name.replace("`", "``") + "`"


def boxed(df: DataFrame) -> DataFrame:
    """All columns of ``df`` in one struct ``v``, so that none clashes with a helper column."""
    return df.select(F.struct(*[F.col(quoted_name(c)) for c in df.columns]).alias("v"))


def unboxed(df: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The columns of the struct ``v`` again, some with new values, and new ones after them."""
    same = [(new[c] if c in new else F.col(f"v.{quoted_name(c)}")).alias(c) for c in columns]
    return df.select(*same, *[e.alias(c) for c, e in new.items() if c not in columns])
