"""Top-k per key over candidate rows.

Candidates come from the scoring tasks, at most ``k`` per key per task, so a
key receives ``k * tasks`` rows however skewed the input was.  The final
selection is ``row_number() <= k`` over ``(dist ASC NULLS LAST, key ASC)``,
which Spark plans as a partial WindowGroupLimit before the shuffle and a
final one after it.  With very many scoring tasks a key's candidate list can
still be long, so an optional first stage ranks within ``(key, salt)``
buckets (salt = hash of the row id) and cuts each to ``k`` before the last
shuffle on the key alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .keys import RowKey

# above this many candidates per key, rank in salted buckets first
SALT_THRESHOLD = 1 << 20


def order_cols(key: RowKey) -> list:
    return [F.col("__d").asc_nulls_last(), *key.order()]


def auto_salt(tasks: int, k: int) -> int:
    per_key = tasks * k
    if per_key <= SALT_THRESHOLD:
        return 1
    return int(min(4096, -(-per_key // SALT_THRESHOLD) * 4))


def top_k_per_key(cands: DataFrame, keys: list[str], key: RowKey, k: int, salt_buckets: int = 1) -> DataFrame:
    """The k first candidates of each key, with their rank ``__r``."""
    if salt_buckets and salt_buckets > 1:
        salted = cands.withColumn("__salt", F.pmod(F.xxhash64(*key.inner), F.lit(salt_buckets)))
        w1 = Window.partitionBy(*keys, "__salt").orderBy(*order_cols(key))
        cands = (salted.withColumn("__r1", F.row_number().over(w1))
                 .filter(F.col("__r1") <= k).drop("__r1", "__salt"))
    w = Window.partitionBy(*keys).orderBy(*order_cols(key))
    return cands.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= k)


def global_top_k(cands: DataFrame, key: RowKey, k: int) -> DataFrame:
    """One ordering over everything: ``TakeOrderedAndProject`` (per-task top-k, one merge)."""
    return cands.orderBy(*order_cols(key)).limit(k)
