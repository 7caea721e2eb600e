"""A corpus in five stages: languages told, near copies, repeats and test items out, sources mixed.

Each stage is a function of (spark, docs, folder of the tables) to a DataFrame; ``run``
writes what a stage returns and reads it again as the next one's docs. All but the last
return the columns of ``documents``; the last returns a row for each copy that the mix
takes, numbered in ``mix_copy``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fireledger.llm import decontaminate, jaccard, langid, mixing, repeats
from fireledger.llm.scratch import stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a score that labelled documents reach (half their least)."""
    return langid.known_language(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return jaccard.one_of_each(docs, width=5, percent=80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 bytes that an earlier one holds."""
    return repeats.text_without_repeats(docs)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", one_of_each_group),
    ("repeats", without_repeats),
    ("decontaminate", without_test_items),
    ("mix", mixed_sources),
]

#: Languages are told by a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
