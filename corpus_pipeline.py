"""A training-corpus pipeline: five operators in a row over ``documents``.

Toxic documents go, boilerplate lines are cut, one document of each group of
near duplicates stays, the sources are mixed to their targets, and what the
mix takes is packed into sequences.  Every stage works on all that the one
before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quiver.llm import jaccard, linededup, mixing, packing, queries, toxicity
from quiver.llm.shared import save


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold against the labelled examples."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), toxicity.THRESHOLD)


def cut_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many sources carry."""
    return linededup.cleaned_documents(docs, queries.MIN_SITES)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    return jaccard.keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, one per source in part."""
    return mixing.mixed_documents(docs, queries.MIX_CAP)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place."""
    return packing.pack_documents(docs, queries.vocabulary("word_bpe_49k.json"), queries.PACK_END_ID,
                                  queries.SEQUENCE)


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", cut_boilerplate),
    ("n-gram Jaccard join", keep_distinct),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

# SQL can express neither the tokenizer nor the packing
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = save(docs, f"stage-{k}")
    return docs
