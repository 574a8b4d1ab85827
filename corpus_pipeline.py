"""A corpus from documents to packed training sequences.

Four stages: quality rules reject, near duplicates are reduced to one document
of each group, sources are mixed to target weights, and the mix is packed. Each
stage takes what its predecessor kept, written as Parquet and read again, and
all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmart.llm import mixing, ngram_join, packing, quality_rules
from obsmart.llm.common import stage

#: Near duplicates: shingles of five words, similarity of 0.8 or more.
WORDS, LEAST = 5, 80


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of linked documents: the one with the smallest
    doc_id, whether ids repeat or are missing. Documents without words are
    groups of their own."""
    return ngram_join.representatives(docs, WORDS, LEAST)


def source_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.emit(mixing.plan(docs))


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of documents in sequences, with their token ids."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("source_mix", source_mix), ("pack", pack)]

#: No SQL engine has the tokenizer; tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents of a folder; a row a piece, without its ids."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, work in STAGES:
        docs = stage(work(spark, docs, folder), f"pipeline-{name}")
    return docs.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
