"""The driver's parquet tables.

Reads are lazy: projections and filters written after ``read_table`` reach the
parquet scan (``ReadSchema`` / ``PushedFilters``), so callers select what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


#: Session setting: partitions that a scan is dealt over before heavy per-row work.
SPREAD_SETTING = "spark.tidemark.spreadPartitions"


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal the rows of ``df`` over ``partitions`` before heavy per-row work (regex, HTML, hashing).

    For tables in a few small files, whose scan would run in one or two tasks; asked for
    by argument or by the session's ``spark.tidemark.spreadPartitions``.  Otherwise the
    scan's own splits (``spark.sql.files.maxPartitionBytes``) stay, without a shuffle and
    without looking at the input.
    """
    n = partitions or int(df.sparkSession.conf.get(SPREAD_SETTING, None) or 0)
    return df.repartition(n) if n else df


#: Rendered pages of a task.
DEALT_ROWS = 20_000


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """Deal ``df`` (of about ``rows`` rows) over tasks of ``DEALT_ROWS``: for small rows of which heavy ones are made, as a
    scan cuts its splits by the bytes on disk and not by the work."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(min(cores, -(-rows // 500)), -(-rows // DEALT_ROWS), 1))
