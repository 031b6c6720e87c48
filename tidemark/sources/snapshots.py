"""Tables that readers survive: immutable snapshots, committed by one file.

A table is a folder of data folders and a log.  Every write puts its rows into a new data folder,
dealt over the table's hash buckets of the key, and then commits by appending one file to the log
that says, for every bucket, which folder holds it now.  Spark makes that file visible in
one step when the job commits, so readers see the old version or the new one, and a job
that dies before leaves unused folders only.  ``upsert`` and ``update`` rewrite the buckets that
their keys fall into; the others keep their files from version to version.

One writer at a time.  Keys are not null; rows without one are refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import last_wins

_LOG = "version long, bucket int, folder string, buckets int"


class Snapshots:
    """The table in ``root`` with the columns of ``schema``, one row per ``key``."""

    def __init__(self, spark: SparkSession, root: str, schema: str, key: str, buckets: int = 16):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.schema = spark.createDataFrame([], schema).schema
        self.buckets = buckets

    # ---- log
    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_LOG).json(f"{self.root}/log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def version(self) -> int:
        """The last committed version; 0 before the first."""
        log = self._log()
        return (log.agg(F.max("version")).first()[0] or 0) if log is not None else 0

    def folders(self, version: int | None = None) -> dict[int, str]:
        """Data folder of each bucket (one row a bucket)."""
        log = self._log()
        version = self.version() if version is None else version
        rows = log.where(F.col("version") == version).collect() if log is not None else []
        if version and not rows:
            raise ValueError(f"no version {version} in {self.root}")
        if rows and rows[0]["buckets"] != self.buckets:
            raise ValueError(f"{self.root} has {rows[0]['buckets']} buckets")
        return {r["bucket"]: r["folder"] for r in rows if r["folder"] is not None}

    def _commit(self, version: int, folders: dict[int, str]) -> int:
        rows = [(version, b, folders.get(b), self.buckets) for b in range(self.buckets)]
        self.spark.createDataFrame(rows, _LOG).coalesce(1).write.mode("append").json(f"{self.root}/log")
        return version

    # ---- data
    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows of a version (the last one), or of some of its buckets."""
        at = {b: f for b, f in self.folders(version).items() if buckets is None or b in buckets}
        if not at:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{f}/__bucket={b}" for b, f in sorted(at.items())])

    def _write(self, rows: DataFrame) -> tuple[str, set[int]]:
        """A new data folder with ``rows``, and the buckets that it holds."""
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        names = [f.name for f in self.schema]
        dealt = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]).withColumn("__bucket", self._bucket(F.col(self.key)))
        dealt.repartition("__bucket").sortWithinPartitions("__bucket", self.key).write.partitionBy("__bucket").parquet(folder)
        try:
            held = self.spark.read.schema(", ".join(["__bucket int", *[f"`{n}` {self.schema[n].dataType.simpleString()}" for n in names]])).parquet(folder)
            return folder, {r[0] for r in held.select("__bucket").distinct().collect()}  # one row a bucket
        except AnalysisException:
            return folder, set()

    def _checked(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(self.key, F.when(F.col(self.key).isNotNull(), F.col(self.key)).otherwise(
            F.raise_error(F.lit(f"a row has no {self.key}")).cast(self.schema[self.key].dataType)))

    def refresh(self, rows: DataFrame) -> int:
        """K6: the rows take the place of all there are; gives the new version."""
        folder, held = self._write(self._checked(rows))
        return self._commit(self.version() + 1, {b: folder for b in held})

    def upsert(self, rows: DataFrame, order: Sequence[str] = ()) -> int:
        """Rows replace those of their key or join the table; of several of a key the last by ``order``."""
        new = self._checked(rows)
        new = last_wins(new, [self.key], list(order)) if order else new
        return self._merge(new, lambda old, new: old.join(new.select(self.key), self.key, "left_anti").select(old.columns).unionByName(new.select(old.columns)))

    def update(self, rows: DataFrame, columns: Sequence[str]) -> int:
        """``columns`` of the rows with a matching key are set; other rows of either side stay as they are."""
        named = rows.select(F.col(self.key).alias("__k"), *[F.col(c).alias(f"__new_{c}") for c in columns])

        def matched(old: DataFrame, _: DataFrame) -> DataFrame:
            both = old.join(named, old[self.key] == F.col("__k"), "left")
            return both.select(*[F.when(F.col("__k").isNotNull(), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in old.columns])

        return self._merge(rows, matched)

    def _merge(self, new: DataFrame, merged) -> int:
        """A version in which the buckets of ``new`` hold ``merged(old rows, new rows)``."""
        at, version = self.folders(), self.version()
        touched = sorted(r[0] for r in new.select(self._bucket(F.col(self.key)).alias("b")).distinct().collect() if r[0] is not None)  # one row a bucket
        folder, held = self._write(merged(self.read(version, touched), new))
        return self._commit(version + 1, {**{b: f for b, f in at.items() if b not in touched}, **{b: folder for b in held}})
