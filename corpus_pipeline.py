"""The corpus pipeline: quality rules, language ID, near duplicates, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.llm.common import documents, keep
from basketry.llm.langid import language_filter
from basketry.llm.ngram_join import near_duplicate_filter
from basketry.llm.packing import pack_documents
from basketry.llm.pii import mask_documents
from basketry.llm.quality import quality_filter


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_filter(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain."""
    return language_filter(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_duplicate_filter(docs)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked and their lengths counted anew."""
    return mask_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("language ID", language_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("PII", personal_data_stage),
    ("best-fit packing", packing_stage),
]

# Tokenisers, models and message passing are beyond SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
