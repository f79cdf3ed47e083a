"""The corpus pipeline: documents in, packed training bins out.

Each stage takes (spark, docs, folder of tables) and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``; null texts, which have no language
and no words, go in the first. How a stage treats other odd rows is told by the
operator it calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dealglass.llm import decontaminate, jaccard, language, packing, quality_rules
from dealglass.llm.common import read, store


def language_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps the documents in a known language that fills a third of them or more."""
    return language.keep(docs)


def quality_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps the documents that pass the quality rules, without their failed lines."""
    return quality_rules.keep(docs, length="n_chars")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps one document of each class of near duplicates."""
    return jaccard.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps the documents of which less than a twentieth is benchmark text."""
    return decontaminate.drop_contaminated(docs, read(spark, folder, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Packs the documents into bins; one row per piece."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language_stage),
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

# Expectation-maximisation, the MinHash forest and best fit are beyond SQL; the
# tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
