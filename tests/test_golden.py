"""Golden check against published topic x industry tables.

Set ``GOLDEN_TABLES`` to a folder of published tables (CSV, first column ``<name>(level)``,
one column per industry, a total last); the test is skipped otherwise.  Each table is
melted back to one row per article (label, industry) and the matrix operator must rebuild
it: the same industry columns in code-point order, the same counts and totals, rows by
total descending (tied rows in any order, as published).
"""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.rollup import topic_matrix

GOLDEN = os.environ.get("GOLDEN_TABLES", "")
TABLES = sorted(glob.glob(os.path.join(GOLDEN, "*.csv"))) if GOLDEN else []


@pytest.mark.skipif(not TABLES, reason="GOLDEN_TABLES not set")
@pytest.mark.parametrize("path", TABLES)
def test_topic_matrix_rebuilds_published_table(spark, path):
    raw = spark.read.options(header=True, encoding="UTF-8").csv(path)
    label, *industries, total = raw.columns
    if not label.endswith(")"):
        pytest.skip("not a topic table")
    counts = raw.select(F.col(f"`{label}`").alias("topic"), F.explode(F.map_from_arrays(
        F.array(*[F.lit(c) for c in industries]),
        F.array(*[F.col(f"`{c}`").cast("int") for c in industries]))).alias("industry", "n"))
    articles = counts.select("topic", "industry", F.explode(F.array_repeat(F.lit(1), F.col("n"))).alias("_"))
    n_articles = articles.count()

    got = topic_matrix(articles, "topic", "industry", total=total)
    assert got.columns == ["topic", *industries, total]
    assert industries == sorted(industries)  # code-point order, as published

    pub = {r[0]: tuple(int(x) for x in r[1:]) for r in raw.collect()}
    mine = [tuple(r) for r in got.collect()]
    assert len(mine) == raw.count() and sum(r[-1] for r in mine) == n_articles
    assert {r[0]: tuple(r[1:]) for r in mine} == pub
    totals = [r[-1] for r in mine]
    assert totals == sorted(totals, reverse=True)
