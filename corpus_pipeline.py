"""A corpus pipeline of training-data operators: good texts, without copies, mixed by source, as token ids.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and read again as the next one's
``docs``. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe, exactdedup, mixing, nearcopies, quality, queries
from millrace.llm.common import table, written
from millrace.session import configure


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is fitted on the given documents that have labels."""
    return quality.keep_good(docs, table(configure(spark), sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    configure(spark)
    return exactdedup.drop_exact_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 0.8 or more of their five-word shingles in common."""
    configure(spark)
    return nearcopies.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's rate says, in random order."""
    configure(spark)
    return mixing.mix(docs, copy_column=None)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their offsets and what they decode to, as digests."""
    configure(spark)
    path, pattern = queries.vocabulary()
    return bpe.round_trip(docs, path, pattern)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("mixing sources", mixed),
    ("byte-level BPE", token_ids),
]

# SQL has neither the classifier nor the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written to the shared folder for the next."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
