"""The resumable streaming ingest equals the batch claim, and reruns add nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators.dedupe import claim
from tidemark.session import scratch_path
from tidemark.streaming import ingest


def rows(df):
    return sorted(tuple(r) for r in df.select("url", "stock_id", "doc_id").collect())


def test_resume_ingest_incremental(spark):
    data = [(f"u{i % 40}", f"s{(i * 7) % 9}", i) for i in range(300)]
    df = spark.createDataFrame(data, "url string, stock_id string, doc_id long")
    root = scratch_path(spark, "ingest-test")
    first, second = df.where(F.col("doc_id") < 200), df.where(F.col("doc_id") >= 200)
    first.repartition(4, "stock_id").write.parquet(f"{root}/landed")
    sink, ckpt = f"{root}/sink", f"{root}/ckpt"
    assert ingest.resume_ingest(spark, f"{root}/landed", df.schema, sink, ckpt) > 0
    assert rows(ingest.claimed(spark, sink)) == rows(claim(first, "url", ["stock_id", "doc_id"]))
    # Nothing new landed: nothing to do.
    assert ingest.resume_ingest(spark, f"{root}/landed", df.schema, sink, ckpt) == 0
    # New files land; only they are read, and the result equals the claim over all rows.
    second.repartition(2, "stock_id").write.mode("append").parquet(f"{root}/landed")
    assert ingest.resume_ingest(spark, f"{root}/landed", df.schema, sink, ckpt) > 0
    assert rows(ingest.claimed(spark, sink)) == rows(claim(df, "url", ["stock_id", "doc_id"]))


def test_a_killed_run_resumes_and_the_log_is_not_read(spark, monkeypatch):
    data = [(f"u{i % 25}", None if i % 31 == 0 else f"s{(i * 7) % 9}", i) for i in range(250)]
    df = spark.createDataFrame(data, "url string, stock_id string, doc_id long")
    root = scratch_path(spark, "ingest-kill")
    df.repartition(5, "doc_id").write.parquet(f"{root}/landed")
    sink, ckpt = f"{root}/sink", f"{root}/ckpt"
    real = ingest.new_claims

    def dies(stream, url, order):
        return real(stream, url, order).withColumn("doc_id", F.expr("if(doc_id % 25 = 3, raise_error('executor lost'), doc_id)"))

    monkeypatch.setattr(ingest, "new_claims", dies)
    with pytest.raises(Exception, match="executor lost"):
        ingest.resume_ingest(spark, f"{root}/landed", df.schema, sink, ckpt, batch_bytes=1000)
    monkeypatch.setattr(ingest, "new_claims", real)
    assert ingest.resume_ingest(spark, f"{root}/landed", df.schema, sink, ckpt, batch_bytes=1000) > 0
    want = rows(claim(df, "url", ["stock_id", "doc_id"]).fillna("none"))
    assert rows(ingest.claimed(spark, sink).fillna("none")) == want
    # The state alone knows what has been claimed: with the log gone, a later finder adds nothing.
    spark.createDataFrame([("u1", "zz", 9999), ("new", "zz", 9999)], df.schema).write.mode("append").parquet(f"{root}/landed")
    ingest.resume_ingest(spark, f"{root}/landed", df.schema, f"{root}/other", ckpt, batch_bytes=1000)
    assert rows(ingest.claimed(spark, f"{root}/other")) == [("new", "zz", 9999)]


def test_the_number_of_batches_does_not_follow_the_files(spark):
    df = spark.createDataFrame([(f"u{i % 40}", f"s{(i * 7) % 9}", i) for i in range(1200)], "url string, stock_id string, doc_id long")
    root = scratch_path(spark, "ingest-share")
    src = ingest.land_files(df, f"{root}/landed", 20)
    assert len(spark.read.schema(df.schema).parquet(src).inputFiles()) >= 60
    size = ingest.share_of_files(spark, src, df.schema, 3, 100)
    assert 2 <= ingest.resume_ingest(spark, src, df.schema, f"{root}/sink", f"{root}/ckpt", batch_bytes=size) <= 4
    assert rows(ingest.claimed(spark, f"{root}/sink")) == rows(claim(df, "url", ["stock_id", "doc_id"]))
    assert ingest.share_of_files(spark, src, df.schema, 3, 1 << 40) == 1 << 40
    assert ingest.share_of_files(spark, ingest.land_files(df.where("doc_id < 0"), f"{root}/none", 20), df.schema, 3, 7) >= 7
