"""The document pipeline: toxicity, exact dedup, SimHash near-dedup, mixing
to target weights, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept,
and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabml.llm import exact_dedup, mixing, simhash, toxicity
from tabml.llm.common import read, shared_table
from tabml.llm.queries import packed
from tabml.session import ship_package

#: a classifier and tokenizer ids aren't SQL; tests hold the rows against brute force
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels, scores below 0.5."""
    ship_package(spark)
    labels = read(spark, sf_dir, "labels").selectExpr("doc_id", "toxic as label")
    return toxicity.drop_toxic(docs, toxicity.fit(docs.select("doc_id", "text"), labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    ship_package(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, up to 3 bits)."""
    ship_package(spark)
    return simhash.drop_near_copies(docs, words=3, distance=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight takes it."""
    ship_package(spark)
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, in windows of 1024 tokens."""
    ship_package(spark)
    return packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, one after the other."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
