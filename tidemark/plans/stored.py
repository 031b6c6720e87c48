"""A stored company table (K6, W3, J2): refresh, keyed upsert and matched update as snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.snapshots import Snapshots
from ..sources.tables import read_table
from . import catalog as C

SCHEMA = "code long, name string, board string, balance double"


@C.register("stored_upsert", """
WITH kept AS (SELECT c_custkey AS code, c_name AS name, c_mktsegment AS board, c_acctbal AS balance FROM customer WHERE c_custkey % 3 <> 0),
ups AS (SELECT c_custkey AS code, upper(c_name) AS name, 'moved' AS board, c_acctbal + 1 AS balance FROM customer WHERE c_custkey % 2 = 0),
merged AS (SELECT * FROM kept WHERE code NOT IN (SELECT code FROM ups) UNION ALL SELECT * FROM ups)
SELECT code, name, CASE WHEN code % 5 = 0 THEN 'listed' ELSE board END AS board, round(balance, 2) AS balance, CAST(3 AS BIGINT) AS version FROM merged""")
def stored_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies are loaded, then some are replaced or join, then a column of some is set; the
    last version is read.  Rows that come twice count by their time; codes without a row are not updated."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    rows = c.select(F.col("c_custkey").cast("long").alias("code"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("board"),
                    F.col("c_acctbal").cast("double").alias("balance"))
    table = Snapshots(spark, scratch_path(spark, "companies"), SCHEMA, "code")
    table.refresh(rows.where("code % 3 <> 0"))
    change = rows.where("code % 2 = 0").select("code", F.upper("name").alias("name"), F.lit("moved").alias("board"), "balance")
    twice = change.withColumn("at", F.lit(1)).unionByName(change.withColumn("balance", F.col("balance") + 1).withColumn("at", F.lit(2)))
    table.upsert(twice, order=["at"])
    version = table.update(rows.where("code % 5 = 0").select("code", F.lit("listed").alias("board")), ["board"])
    return table.read().withColumn("balance", F.round("balance", 2)).withColumn("version", F.lit(version).cast("long"))
