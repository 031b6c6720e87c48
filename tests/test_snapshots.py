"""Snapshot tables: versions, touched buckets, and a job that dies before its commit."""

from __future__ import annotations

import pathlib

import pytest
from pyspark.sql import functions as F

from tidemark.sources.snapshots import Snapshots

SCHEMA = "code string, price double, n long"


def table(spark, scratch, **more):
    return Snapshots(spark, f"{scratch}/table", SCHEMA, "code", **more)


def rows(spark, *r):
    return spark.createDataFrame(list(r), SCHEMA)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions_of_a_table(spark, scratch):
    t = table(spark, scratch)
    assert t.version() == 0 and got(t.read()) == []
    assert t.refresh(rows(spark, ("a", 1.0, 1), ("b", 2.0, 2), ("c", 3.0, 3))) == 1
    assert t.upsert(rows(spark, ("b", 20.0, 5), ("b", 21.0, 4), ("d", 4.0, 9)), order=["n"]) == 2
    assert t.update(rows(spark, ("a", None, 0), ("x", 9.0, 9)), ["price"]) == 3
    assert got(t.read().na.fill(-1.0)) == [("a", -1.0, 1), ("b", 20.0, 5), ("c", 3.0, 3), ("d", 4.0, 9)]
    assert got(t.read(1)) == [("a", 1.0, 1), ("b", 2.0, 2), ("c", 3.0, 3)]
    assert t.refresh(rows(spark)) == 4 and got(t.read()) == []
    assert t.upsert(rows(spark, ("z", 1.0, 1))) == 5 and got(t.read()) == [("z", 1.0, 1)]
    with pytest.raises(ValueError, match="no version 9"):
        t.read(9)


def test_untouched_buckets_keep_their_files(spark, scratch):
    t = table(spark, scratch, buckets=8)
    t.refresh(spark.range(400).selectExpr("cast(id AS string) AS code", "1.0 AS price", "id AS n"))
    before = t.folders()
    t.upsert(rows(spark, ("7", 2.0, 7), ("new", 3.0, 0)))
    after = t.folders()
    touched = {b for b in after if after[b] != before.get(b)}
    assert len(before) == 8 and 1 <= len(touched) <= 2
    assert t.read().count() == 401 and t.read().where("code = '7'").first()["price"] == 2.0
    assert sorted(p.name for p in pathlib.Path(after[min(touched)]).iterdir() if p.name.startswith("__bucket")) == sorted(f"__bucket={b}" for b in touched)


def test_a_job_that_dies_before_its_commit_changes_nothing(spark, scratch, monkeypatch):
    t = table(spark, scratch)
    t.refresh(rows(spark, ("a", 1.0, 1), ("b", 2.0, 2)))
    reader = t.read()
    with monkeypatch.context() as m:
        m.setattr(Snapshots, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            t.refresh(rows(spark, ("c", 3.0, 3)))
        with pytest.raises(RuntimeError, match="killed"):
            t.upsert(rows(spark, ("a", 9.0, 9)))
    bad = rows(spark, ("a", 5.0, 5)).withColumn("price", F.expr("if(n = 5, raise_error('task failed'), price)"))
    with pytest.raises(Exception, match="task failed"):
        t.upsert(bad)
    with pytest.raises(Exception, match="no code"):
        t.refresh(rows(spark, (None, 1.0, 1)))
    assert t.version() == 1 and got(reader) == got(t.read()) == [("a", 1.0, 1), ("b", 2.0, 2)]
    t.upsert(rows(spark, ("a", 7.0, 7)))
    assert got(reader) == [("a", 1.0, 1), ("b", 2.0, 2)]  # a reader that began before keeps its version
    assert got(table(spark, scratch).read()) == [("a", 7.0, 7), ("b", 2.0, 2)]
