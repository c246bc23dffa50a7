"""Corpus pipeline: language, exact and near duplicates, mixture, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of its predecessor; all but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestride.llm.common import read, stored
from lodestride.llm.exact_dedup import distinct_documents
from lodestride.llm.language_id import accepted_documents
from lodestride.llm.mixing import mixed_documents
from lodestride.llm.packing import pack_in_order
from lodestride.llm.simhash import one_of_each

NEAR_WORDS = 5
MIX_WEIGHTS: dict[str, float] | None = None  # by source; None: row counts to the power MIX_ALPHA
MIX_ALPHA = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language."""
    return accepted_documents(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the largest doc_id) of each text."""
    return distinct_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of near copies."""
    return one_of_each(docs, words_per_shingle=NEAR_WORDS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, stored in an order that interleaves sources at their target weights."""
    return mixed_documents(docs, weights=MIX_WEIGHTS, alpha=MIX_ALPHA)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences, which follow the mixed order in which ``docs`` are stored."""
    return pack_in_order(docs)


STAGES = [("language", language), ("exact", exact), ("near", near), ("mixture", mixture), ("packing", packed)]

# Learned models, tokenisation and links over chains aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that every stage kept."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
