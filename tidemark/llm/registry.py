"""The registered queries of this subpackage and their SQL.

Each query runs its operator over its whole table with production parameters.  Queries
without SQL (tokenizers, hashes that the SQL engine lacks, trained models, iterations) are
tested against plain versions in tests/llm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_table
from . import (conversations, decontaminate, languages, licenses, negatives, packing, pii, quality, secrets, simhash,
               tokens, toxicity, urls)


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, model)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(read_table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary("byte_bpe_50k.json"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", "page_id", "url")
    return urls.judge(pages, urls.labelled_pages(pages, read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents", "doc_id", "text"), read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_digest(read_table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary("word_bpe_49k.json"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read_table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.recognise(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return languages.predict(docs, languages.fit(docs))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_toxicity, op2_token_counts, op3_url_filters, op4_decontamination, op5_packing, op6_pii,
    op7_secret_scans, op8_license_scans, op9_simhash, op10_quality_rules,
    op11_language_id, op12_conversation_repair, op13_hard_negatives)}

ORACLE: dict[str, str] = {"op3_url_filters": urls.ORACLE_SQL, "op8_license_scans": licenses.ORACLE_SQL,
                          "op10_quality_rules": quality.ORACLE_SQL, "op13_hard_negatives": negatives.ORACLE_SQL}
