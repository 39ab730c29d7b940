"""Corpus pipeline: toxicity, exact and near duplicates, benchmark leaks, packing.

Each stage reads what its predecessor kept, written as Parquet, and its
decision takes effect: all but the last return the kept rows with the columns
of documents, the last the pieces of the packed windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowcast.llm import decontam, exactdedup, neardup, packing, toxicity
from rowcast.llm.common import table, written
from rowcast.llm.queries import packed_digests


def clean_of_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar scores below its threshold."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that of the smallest doc_id."""
    return exactdedup.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return neardup.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents in windows of 2048 tokens, one row per piece."""
    return packed_digests(docs)


STAGES = [("toxicity", clean_of_toxic), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontaminate), ("packing", pack)]

#: The similarity join and the tokenizer have no SQL form; the tests hold the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; a stage's rows are a table before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
