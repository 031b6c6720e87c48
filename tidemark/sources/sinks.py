"""Sinks: stage tables, result files, JSON export, full refresh.

Writes are the only actions of a job.  Stage tables go under the shared checkpoint
root, so a later stage (or a restarted job) can read them back and the lineage is cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_stage(df: DataFrame, root: str, run: str, name: str) -> str:
    """K1: persist a stage (documents, clusters, merges) as Parquet; returns the path."""
    path = f"{root.rstrip('/')}/{run}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_result(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> None:
    """K2/K3: result projection or topic table; CSV gets a header row."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_json(df: DataFrame, path: str, loaded_at: str | None = None) -> None:
    """K5: JSON-lines export, with a load timestamp column when given."""
    if loaded_at is not None:
        df = df.withColumn("scraped_at", F.lit(loaded_at))
    df.write.mode("overwrite").json(path)


def land_records(df: DataFrame, order: str, path: str, per_file: int = 10_000) -> str:
    """Records as JSON arrays, one a file, for ``readers.read_json_records``.

    ``order`` is a number that says a record's place; a file holds those of ``per_file``
    numbers in a row, and files and records are in that order.
    """
    record = F.struct(*[c for c in df.columns if c != order])
    part = F.floor(F.col(order) / per_file)
    arrays = df.groupBy(part.alias("__part")).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), record.alias("r")))).alias("__e"))  # per_file at most
    lines = arrays.orderBy("__part").select(F.to_json(F.transform("__e", lambda e: e["r"])).alias("value"))
    lines.write.option("maxRecordsPerFile", 1).text(path)
    return path


def overwrite_table(df: DataFrame, path: str, cluster_by=None) -> None:
    """K6: full refresh of a table folder: deletes, then writes.

    Readers of the folder notice; ``snapshots.Snapshots.refresh`` is the form that they survive.
    ``cluster_by`` sorts within files so Parquet min/max statistics act like the
    secondary indexes of the original store.
    """
    if cluster_by:
        df = df.sortWithinPartitions(*cluster_by)
    df.write.mode("overwrite").parquet(path)
