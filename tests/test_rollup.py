"""Profile, pivot, brief, dominant, tree and roll-up."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidemark.operators import rollup as R


def test_topic_matrix_counts_total_order(spark):
    df = spark.createDataFrame([("t1", "x"), ("t1", "x"), ("t1", "y"), ("t2", "y"), (None, "x"),
                                ("t3", "z")], "topic string, ind string")
    m = R.topic_matrix(df, "topic", "ind")
    assert m.columns == ["topic", "x", "y", "z", "total"]
    assert [tuple(r) for r in m.collect()] == [("t1", 2, 1, 0, 3), ("t2", 0, 1, 0, 1), ("t3", 0, 0, 1, 1)]


def test_profile_and_counts(spark):
    df = spark.createDataFrame([("s1", "b"), ("s2", "a"), ("s1", "b")], "stock string, ind string")
    p = R.corpus_profile(df, "stock", "ind").first()
    assert (p["n_rows"], p["n_stocks"], p["n_industries"], p["industries"]) == (3, 2, 2, ["a", "b"])
    assert [tuple(r) for r in R.industry_counts(df, "ind").collect()] == [("b", 2), ("a", 1)]


def test_dominant_ties_go_to_smallest(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "c"), (2, None), (2, None)],
                               "child int, parent string")
    got = sorted(tuple(r) for r in R.dominant(df, "child", "parent").collect())
    assert got == [(1, "a"), (2, "c")]


def test_topic_brief(spark):
    df = spark.createDataFrame([
        (1, 0, "x", "long text here"), (2, 0, "y", "ab"), (3, 0, "y", "cd"), (4, 0, "z", "a\nb"),
        (5, 1, "x", "only"), (6, None, "x", "none")], "doc int, topic int, ind string, text string")
    got = {r["topic"]: r for r in R.topic_brief(df, "topic", "ind", "text", "doc").collect()}
    assert set(got) == {0, 1}
    assert got[0]["size"] == 4 and got[0]["top_industries"] == ["y(2)", "x(1)", "z(1)"]
    assert got[0]["samples"] == ["ab", "cd", "a b"]
    assert got[1]["samples"] == ["only"]


def test_label_template(spark):
    df = spark.createDataFrame([(1, 10), (2, 10), (2, None)], "medium int, fine int")
    t = json.loads(R.label_template(df, ["medium", "fine"]).first()["template"])
    assert t == {"medium": {"1": "", "2": ""}, "fine": {"10": ""}}


#: (id, parent, level, count, value) of trees worked out by hand.
TREES = [
    [("All", "", "root", 5, 12), ("i0", "All", "industry", 3, 9), ("i1", "All", "industry", 3, 3),
     ("m0", "i0", "medium", 4, 9), ("f0", "m0", "fine", 2, 2), ("f1", "m0", "fine", 7, 7)],
    [("All", "", "root", 100, 100), ("i0", "All", "industry", 0, 0), ("m0", "i0", "medium", 0, 0), ("f0", "m0", "fine", 0, 0)],
    [("All", "", "root", 0, 6), ("i0", "All", "industry", 1, 6), ("m0", "i0", "medium", 1, 5), ("m1", "i0", "medium", 1, 1), ("f0", "m0", "fine", 5, 5)],
]


def test_roll_up_of_trees_worked_by_hand(spark):
    for tree in TREES:
        df = spark.createDataFrame([t[:4] for t in tree], "id string, parent string, level string, count int")
        assert {r["id"]: r["value"] for r in R.roll_up(df).collect()} == {t[0]: t[4] for t in tree}


def test_tree_nodes(spark):
    df = spark.createDataFrame([
        ("a", 0, 0), ("a", 0, 0), ("b", 0, 1), ("b", 1, 2), ("b", 1, 2), ("c", None, None)],
        "ind string, med int, fin int")
    nodes = {r["id"]: r for r in R.tree_nodes(df, "ind", "med", "fin").collect()}
    assert nodes["All"]["count"] == 6 and nodes["All"]["parent"] == ""
    assert nodes["ind|a"]["color"] == "#4C78A8" and nodes["ind|b"]["color"] == "#F58518"
    # medium 0: a twice, b once -> parent a; medium 1 -> b
    assert nodes["med|0"]["parent"] == "ind|a" and nodes["med|0"]["color"] == "#4C78A8"
    assert nodes["med|1"]["parent"] == "ind|b"
    assert nodes["fin|2"]["parent"] == "med|1" and nodes["fin|2"]["color"] == "#F58518"
    assert nodes["fin|2"]["share"] == 1.0
    assert nodes["All"]["share"] is None
    # value >= sum of children everywhere
    by_parent: dict = {}
    for n in nodes.values():
        if n["parent"]:
            by_parent[n["parent"]] = by_parent.get(n["parent"], 0) + n["value"]
    assert all(nodes[p]["value"] >= s for p, s in by_parent.items())
