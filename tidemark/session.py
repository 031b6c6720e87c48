"""Session defaults and the shared checkpoint folder.

Everything in the package takes a ``SparkSession`` from the caller; this module only
supplies sane defaults for scripts and tests, and resolves where lineage-cutting
writes go (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batch size for mapInPandas / applyInPandas workers.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
}


def get_spark(master: str | None = None, app: str = "tidemark",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be present (a machine-local folder would not survive
    the loss of an executor).  Only in local mode, where it is commonly unset, a
    folder is created under the system temp directory and registered on the session.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(root)
    spark.conf.set("spark.checkpoint.dir", root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df, name: str):
    """Write ``df`` once into the shared checkpoint folder and go on from the copy.

    The copy's size is known, so Spark broadcasts it if it is small, and several branches
    read it without repeating its work.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so stdlib code can list a local folder (tests only)."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


def cut_lineage(df):
    """Materialise ``df`` in the shared checkpoint folder and continue from the copy.

    Used where a small result of a large computation is referenced many times (a
    topic-sized table that feeds several branches): the large work runs once, the
    branches read the reliable copy, and a lost executor does not force a recompute.
    """
    spark = df.sparkSession
    root = checkpoint_root(spark)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return df.checkpoint(eager=True)
