"""The corpus pipeline: stages over `documents`, each written as Parquet and read by the next.

Each stage works on all that the one before kept: quality, near duplicates, personal data, mixing
of sources, packing. doc_id identifies a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import attention
from millrace.llm.buckets import pack_buckets
from millrace.llm.common import outcome, table
from millrace.llm.fair_mix import mixed
from millrace.llm.fragment_join import keep_first
from millrace.llm.sanitise import sanitise
from millrace.settings import remove, scratch

# A document goes when label 1 is less likely than this.
LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; rows with a null doc_id have no score and stay."""
    def rejected() -> DataFrame:
        model = attention.fit(docs, table(spark, sf_dir, "labels"))
        return attention.score(docs, model).where(F.col("score") < LEAST_QUALITY).select(
            "doc_id").distinct()
    bad = outcome(spark, "rejected", rejected)
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, Jaccard 0.8."""
    return keep_first(docs, k=5, num=4, den=5)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that give it away are replaced in the texts."""
    return sanitise(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it: by source weights 1, 2, 3, ..., three times at most.

    Documents without words are never taken.
    """
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each sequence of the mix lies: its length bucket, batch and slot."""
    return pack_buckets(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates),
          ("personal_data", personal_data), ("source_mix", source_mix), ("packing", packing)]
# A trained network and a dynamic programme are not SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. The work tables of a stage, and the output of the one before it, are
    removed once its own output is written."""
    docs, outputs = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        outcome(spark, name, lambda: stage(spark, docs, sf_dir), path)
        outputs.append(path)
        docs = spark.read.parquet(path)
        for old in outputs[:-1]:
            remove(spark, old)
        del outputs[:-1]
    return STAGES[-1][1](spark, docs, sf_dir)
