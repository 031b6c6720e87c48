"""Plan shape: pruned scans, pushed filters, skew-safe operators, no extra shuffles at scale."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tidemark.operators import dedupe
from tidemark.plans.catalog import QUERIES
from tidemark.sources.tables import SPREAD_SETTING, read_table, spread

from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_spread_only_when_asked_for(spark):
    few = read_table(spark, SF_SMALL, "documents", "doc_id", "text")
    assert "RoundRobinPartitioning(6)" in plan(spread(few, 6))
    assert "RoundRobinPartitioning" not in plan(spread(few))
    spark.conf.set(SPREAD_SETTING, "5")
    try:
        assert "RoundRobinPartitioning(5)" in plan(spread(few))
    finally:
        spark.conf.unset(SPREAD_SETTING)


def test_scans_are_pruned_and_filtered(spark):
    p = plan(QUERIES["industry_lookup"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in p
    q = plan(QUERIES["clean_text"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in q
    assert "PushedFilters: [IsNotNull(text)" in q


def test_dedupe_combines_map_side_and_top_n_limits_per_task(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    p = plan(dedupe.first_wins(df.withColumn("v", F.col("id") * 2), ["k"], ["id"]))
    assert p.count("Aggregate") >= 2 and "partial_min_by" in p  # partial aggregate before the exchange
    t = plan(dedupe.top_n(df, ["k"], ["id"], 5))
    assert t.count("WindowGroupLimit") == 2  # before and after the shuffle


def test_no_cartesian_or_python_row_udfs(spark):
    for key in ("topic_keywords", "tree_nodes", "chain_rows", "knn_graph", "topic_brief"):
        p = plan(QUERIES[key](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key
        assert "BatchEvalPython" not in p, key


def test_small_staged_tables_meet_their_rows_unshuffled(spark):
    chain = plan(QUERIES["chain_rows"](spark, SF_SMALL))
    assert not re.search(r"hashpartitioning\(chain_ic#\d+, \d+\)", chain)
    kw = plan(QUERIES["topic_keywords"](spark, SF_SMALL))
    assert "SortMergeJoin" not in kw and "BroadcastHashJoin" in kw
