"""Token counts through a digest cache.

A text's key is the SHA-256 of its content (null as empty; no other change, since these
tokenizers count every byte of a text) beside the SHA-256 of the tokenizer file.  Documents
are joined to the stored counts; only the distinct contents without a stored count are
encoded, and their counts are appended.  The cache is a Parquet folder with one subfolder
per tokenizer version; it may hold a digest twice (two jobs at a time, a retried job), so
readers take one row per digest.

Edge cases: null and empty texts have no bytes and no tokens; copies and repeated rows are
encoded once and each counted; rows without a doc_id are counted too; texts of any length
are encoded whole; an empty table gives an empty result and adds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import join_sized, staged, text_of, tidy
from .tokenizing import encoder, slices, tokenizer_digest

LIMIT = 1024
#: Session setting that names a lasting cache folder; unset: a new one for each call.
CACHE_SETTING = "spark.tidemark.tokenCountCache"
_SCHEMA = "digest binary, n_tokens long"


def stored_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(digest, n_tokens) of the cache, one row per digest; empty if the folder is missing."""
    try:
        held = spark.read.schema(_SCHEMA).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SCHEMA)
    return held.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def encode_counts(texts: DataFrame, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) of rows (digest, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            texts = b.column(1).to_pylist()
            counts = [n for a, z in slices(texts) for n in enc.counts(texts[a:z]).tolist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return texts.select("digest", "text").mapInArrow(tidy(run), _SCHEMA)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of ``docs``.

    ``cache``: the cache folder; default the session's ``spark.tidemark.tokenCountCache``,
    else a new folder in the shared checkpoint folder, so that such a call counts all.
    """
    spark = docs.sparkSession
    cache = cache or spark.conf.get(CACHE_SETTING, None) or scratch_path(spark, "token-counts")
    folder = f"{cache.rstrip('/')}/tokenizer={tokenizer_digest(tokenizer)}"
    text = text_of()
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    misses = keyed.select("digest", "text").join(stored_counts(spark, folder), "digest", "left_anti")
    # One text per digest: copies meet in the map task already, so a hot content is one row per task.
    distinct = misses.groupBy("digest").agg(F.first("text").alias("text"))
    encode_counts(distinct, tokenizer).write.mode("append").parquet(folder)
    rows = keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    # Only digests that rows have: how many of them shows which are hot.
    held = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).join(stored_counts(spark, folder), "digest")
    return (join_sized(rows, staged(held, "token-counts-met"), "digest", "n")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
