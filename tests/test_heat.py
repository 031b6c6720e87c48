"""Heat and correlation (E1-E3) and load metrics (A11) on hand-worked rows."""

from __future__ import annotations

from tidemark.operators import heat, market


def quotes(spark):
    return spark.createDataFrame([("a", 100, 2.0), ("b", 300, -1.0), ("c", 50, None)], "stock_code string, volume long, change_pct double")


def test_topic_heat_counts_each_stock_once(spark):
    m = spark.createDataFrame([("t", "a"), ("t", "a"), ("t", "b"), ("t", "c"), ("t", "x"), ("u", "c"), (None, None)], "topic string, stock_code string")
    got = {r["topic"]: tuple(r)[1:] for r in heat.topic_heat(m, quotes(spark)).collect()}
    assert got == {"t": (5, 450, -0.25), "u": (1, 50, None), None: (1, None, None)}


def test_chain_heat(spark):
    c = spark.createDataFrame([("k", "s", "a"), ("k", "s", "a"), ("k", "s", "b"), ("k", "s", "c"), ("k", "r", "x")], "chain_ic string, segment string, stock_code string")
    got = {tuple(r)[:2]: tuple(r)[2:] for r in heat.chain_heat(c, quotes(spark)).collect()}
    assert got == {("k", "s"): (3, 450, 0.5, 0.5), ("k", "r"): (1, None, None, None)}


def test_event_corr_by_lag(spark):
    days = [("a", f"d{i}", n, float(c)) for i, (n, c) in enumerate([(1, 9), (2, 1), (3, 2), (5, 3)])] + [("b", "d0", 1, None), ("b", "d1", 1, 2.0)]
    df = spark.createDataFrame(days, "stock_code string, day string, mentions long, change_pct double")
    got = {(r["stock_code"], r["lag"]): (r["pairs"], r["corr"]) for r in heat.event_corr(df, 2).collect()}
    assert got[("a", 1)][0] == 3 and abs(got[("a", 1)][1] - 1.0) < 1e-9
    assert got[("a", 0)][0] == 4 and got[("a", 0)][1] < 0
    assert got[("b", 0)] == (1, None) and got[("b", 1)] == (1, None) and got[("b", 2)] == (0, None)


def test_load_metrics(spark):
    t = spark.createDataFrame([("a", True), ("b", False), ("c", True)], "stock_code string, quote_matched boolean")
    c = spark.createDataFrame([("k",), ("k",), ("m",)], "chain_ic string")
    got = {r["metric"]: r["value"] for r in market.load_metrics(t, t.limit(0), c).collect()}
    assert got == {"rows": 3, "rows_updated": 2, "rows_fetched": 0, "chains_seen": 2}
