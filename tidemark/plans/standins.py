"""Stand-in inputs built from the driver tables.

The driver's tables hold no market text, so each operator runs on a table with the
same shape (SURVEY §7.3).  Documents ⋈ embeddings play articles with topics:
fine topic = ``label``, medium topic = ``floor(label / 3)`` (so fine nests in medium),
industry = ``lang`` (or ``source``), stock = ``source``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text, has_text, strip
from ..sources.tables import read_table, spread


def kept_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows a CSV reader keeps (raw text)."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return d.where(has_text("text")).select("doc_id", F.col("source").alias("stock_id"), "lang", "text")


def _cleaned(d: DataFrame) -> DataFrame:
    """P2 + P3, after spreading the rows over the cores (the regex work is per row)."""
    return spread(d).withColumn("text", clean_text(strip("text")))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + P2 + P3 over documents: rows a CSV reader keeps, with cleaned text."""
    return _cleaned(kept_docs(spark, sf_dir))


def topic_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles ⋈ topic assignments on the document key (inner).

    The join comes first so only documents with a topic are cleaned.
    """
    v = read_table(spark, sf_dir, "embeddings", "vec_id", "label")
    v = v.select(F.col("vec_id").alias("doc_id"),
                 F.col("label").alias("cluster_fine"),
                 F.floor(F.col("label") / 3).cast("int").alias("cluster_medium"))
    return _cleaned(kept_docs(spark, sf_dir).join(v, "doc_id"))


def both_levels(df: DataFrame) -> DataFrame:
    """One row per (document, level): ``level`` in (medium, fine), ``topic`` the cluster."""
    return df.select("*", F.explode(F.array(
        F.struct(F.lit("medium").alias("level"), F.col("cluster_medium").alias("topic")),
        F.struct(F.lit("fine").alias("level"), F.col("cluster_fine").alias("topic")))).alias("__lv")
    ).select("*", "__lv.level", "__lv.topic").drop("__lv")
