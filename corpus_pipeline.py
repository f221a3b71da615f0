"""Training-data pipeline over ``documents``: quality filter, line
deduplication, near-duplicate removal, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and reread as the next stage's ``docs``. All but the last
return the columns of ``documents``; the last returns packed pieces. A stage
works on all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkprep.llm import decontaminate, line_dedup, minhash, packing, quality
from sparkprep.llm.common import saved, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accept(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; every document stays."""
    return line_dedup.drop_lines(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate group stays."""
    return minhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in length buckets and token-budget batches."""
    return packing.pack(docs)


STAGES = [
    ("quality_filter", quality_filter),
    ("line_dedup", line_deduplication),
    ("near_dedup", near_deduplication),
    ("decontamination", decontamination),
    ("packing", packed),
]

#: No stage sequence with a trained model and a dynamic program is SQL;
#: tests hold each stage and the whole against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply ``STAGES`` in order to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = saved(docs)
    return docs
