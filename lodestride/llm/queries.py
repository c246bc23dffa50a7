"""Queries opN_<name>: each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestride.llm import exact_dedup, language_id, lexical_search, licenses, mixing, neighbors, packing, quality, secrets, simhash, suffix_dedup, toxicity, vector_codes
from lodestride.llm.common import read


def op1_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbors.nearest(read(spark, sf_dir, "embeddings"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "source"))
    return mixed.select("row.doc_id", "row.source", "mix_source", "share", "block", "pos", "slot", "release", "due", "mix_order")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure_quality(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("failed")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")).drop("label")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark").select("item_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_neighbors, op2_exact_dedup, op3_secrets, op4_mixing, op5_simhash, op6_suffix_dedup, op7_toxicity, op8_language_id, op9_packing, op10_licenses, op11_vector_codes, op12_quality_rules, op13_lexical_search)
}

ORACLES: dict[str, str] = {
    "op11_vector_codes": vector_codes.SQL,
    "op12_quality_rules": quality.SQL,
    "op13_lexical_search": lexical_search.SQL,
    "op2_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents""",
}
