"""Keyed dedupe, top-n, claims and resume sets (W1-W5, U1-U3, J5), including a hot key."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import dedupe as D
from tidemark.operators.market import first_seen, update_matched


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_first_and_last_wins(spark):
    df = spark.createDataFrame([("a", 1, 0, "x"), ("a", 0, 5, "y"), ("a", 0, 2, "z"),
                                ("b", 2, 0, "p"), ("b", 2, 1, "q")],
                               "k string, prio int, ord int, v string")
    assert rows(D.first_wins(df, ["k"], ["prio", "ord"]), "k", "v") == [("a", "z"), ("b", "p")]
    assert rows(D.last_wins(df, ["k"], ["prio", "ord"]), "k", "v") == [("a", "x"), ("b", "q")]


def test_top_n_with_hot_key_equals_pandas(spark):
    rnd = random.Random(7)
    data = [(0 if i % 3 == 0 else rnd.randrange(1, 50), rnd.randrange(10_000), i) for i in range(6000)]
    df = spark.createDataFrame(data, "g int, score int, id int")
    got = rows(D.top_n(df, ["g"], ["score", "id"], 10), "g", "id", "rank")
    pdf = pd.DataFrame(data, columns=["g", "score", "id"]).sort_values(["g", "score", "id"])
    pdf["rank"] = pdf.groupby("g").cumcount() + 1
    exp = sorted(tuple(int(x) for x in r) for r in pdf[pdf["rank"] <= 10][["g", "id", "rank"]].values)
    assert got == exp


def test_claim_first_finder_across_run(spark):
    df = spark.createDataFrame([("u1", "s2", 0), ("u1", "s1", 3), ("u2", "s3", 1), ("u2", "s3", 0)],
                               "url string, stock string, rank int")
    assert rows(D.claim(df, "url", ["stock", "rank"]), "url", "stock", "rank") == [
        ("u1", "s1", 3), ("u2", "s3", 0)]


def test_pending_done_all_done(spark):
    req = spark.createDataFrame([(s,) for s in ["a", "b", "c"]], "k string")
    done = spark.createDataFrame([(s,) for s in ["b", "z", "b"]], "k string")
    assert rows(D.pending(req, done, "k"), "k") == [("a",), ("c",)]
    assert rows(D.done_requested(req, done, "k"), "k") == [("b",)]
    assert not D.all_done(req, done, "k")
    assert D.all_done(req.where("k = 'b'"), done, "k")


def test_first_seen_priority_then_ordinal(spark):
    a = spark.createDataFrame([("1", "A-first", 1), ("2", "A-two", 0)], "stock_code string, v string, ordinal long")
    b = spark.createDataFrame([("1", "B", 0), ("3", "B-three", 0)], "stock_code string, v string, ordinal long")
    got = rows(first_seen([a, b]), "stock_code", "v", "priority")
    assert got == [("1", "A-first", 0), ("2", "A-two", 0), ("3", "B-three", 1)]


def test_update_matched_takes_nulls_and_keeps_unmatched(spark):
    base = spark.createDataFrame([("1", "n1"), ("2", "n2")], "stock_code string, stock_name string")
    upd = spark.createDataFrame([("1", None, "", "", None, "2026-01-02"), ("9", 1.0, "+1", "+1%", 5, "x")],
                                "stock_code string, close_price double, change_val string, "
                                "change_pct string, volume bigint, quote_date string")
    first = update_matched(base, upd, "stock_code")
    got = {r["stock_code"]: r for r in first.collect()}
    assert set(got) == {"1", "2"}
    assert got["1"]["quote_matched"] and got["1"]["close_price"] is None and got["1"]["change_val"] == ""
    assert not got["2"]["quote_matched"] and got["2"]["quote_date"] is None
    # A second update that misses stock 1 keeps its old (stale) values.
    upd2 = upd.where(F.col("stock_code") == "9")
    again = {r["stock_code"]: r for r in update_matched(first.drop("quote_matched"), upd2, "stock_code").collect()}
    assert again["1"]["quote_date"] == "2026-01-02" and not again["1"]["quote_matched"]
