"""Cleans the document table in five stages; each stage works on all rows its predecessor kept.

Toxic documents go, then documents without a language, then all but one document of equal texts, then
all but one of each group of near duplicates; what stays is packed into token windows.
Every stage is written to the shared folder and read again, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerostrata.llm import language, near_dedup, packing, toxicity
from aerostrata.llm.common import kept_table, read, workers_import
from aerostrata.llm.exact_dedup import keep_first_copies


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a model learnt from the labels of ``docs``."""
    workers_import(spark)
    return toxicity.keep_harmless(docs, toxicity.learn(docs, read(spark, sf_dir, "labels")))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language."""
    workers_import(spark)
    return language.keep_identified(docs, language.learn(docs))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents of equal text the one with the largest identifier."""
    workers_import(spark)
    return keep_first_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the one with the smallest identifier."""
    workers_import(spark)
    return near_dedup.keep_representatives(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the sequences."""
    workers_import(spark)
    return packing.pack_documents(docs, packing.vocabulary_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("language_id", language_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("packing", packing_stage),
]

#: Two stages score by learnt models, which SQL does not express; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again before the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
