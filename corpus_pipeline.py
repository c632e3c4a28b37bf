"""From raw documents to packed training sequences: five stages, each written as Parquet and read again.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import mixing, neardup, packing, paragraphs, queries, toxicity
from tidemark.llm.common import importable, read
from tidemark.session import work_dir


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine rejects go."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, a similarity of 0.8 or more."""
    importable(spark)
    return neardup.drop_near_duplicates(docs, width=5, percent=80)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat are cut out of all documents but the first; the documents stay."""
    importable(spark)
    cut = paragraphs.remove_passages(docs)
    if "n_chars" not in cut.columns:
        return cut
    length = F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", length)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights: rows go, stay or are repeated."""
    importable(spark)
    return mixing.apply_mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as token pieces placed in sequences of 2048."""
    importable(spark)
    return packing.best_fit(docs, queries.vocabulary(), capacity=2048)


STAGES = [("toxicity", toxic), ("near duplicates", near_duplicates), ("substring dedup", substrings),
          ("source mixing", mixed), ("best-fit packing", packed)]

# Kernel machines, components of links and packing are not expressible in SQL; tests/llm check each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
