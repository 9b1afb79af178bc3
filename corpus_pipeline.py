"""A training corpus in five stages, from documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns the rows the next one works on; each result
is written and read again. All stages but the last return the columns of ``documents``. When a
stage begins, the working files of the one before are deleted, since its result has been written;
one pipeline runs in a session at a time.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from forumflow.llm import decontaminate, jaccard, language_id, packing, quality
from forumflow.llm.staging import staged, table, working_files

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and are no outliers of their language and source."""
    with working_files(spark):
        return quality.quality_filter(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined."""
    with working_files(spark):
        return language_id.language_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    with working_files(spark):
        return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    with working_files(spark):
        return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their sequences."""
    with working_files(spark):
        return packing.pack_documents(docs, TOKENIZER, end_id=1)


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs


# Tokens cannot be expressed in SQL; a test runs the stages against brute force.
ORACLE_SQL = None
