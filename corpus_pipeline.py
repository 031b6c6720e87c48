"""The corpus pipeline: quality rules, near duplicates, decontamination, secrets, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir), works on all
rows of ``docs`` and returns the next stage's documents, the last one the packed pieces.
``run`` writes each stage's rows to the shared checkpoint folder and reads them back.

Edge cases: each stage keeps the columns of its input (the last one aside), takes null and
empty texts, repeated rows and an empty table, and does what its operator's module says of
them: the quality rules reject texts without words, of each group of near duplicates one
row stays, that of the smallest doc_id, rows without one last; rows are told apart by
doc_id and text, so a text that shares its doc_id with others is judged on its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, packing, quality, secrets, simhash
from tidemark.llm.registry import vocabulary
from tidemark.session import scratch_path
from tidemark.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_quality(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that of the smallest doc_id."""
    return simhash.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets cut out of their texts."""
    return secrets.redact(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences with their token ids."""
    pieces = packing.pack(docs, vocabulary("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules), ("simhash_dedup", simhash_dedup), ("decontamination", decontamination),
    ("secret_scans", secret_scans), ("packing", pack_documents)]

#: SimHash, the forest and the tokenizer have no SQL; tests/llm compares with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
