"""Scalar Column functions (P1-P18, M1) against their stated semantics."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import market as M
from tidemark.functions import text as X
from tidemark.operators.dims import keyword_list, resolve_code


def one(spark, expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"v {typ}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


CLEAN_CASES = [
    ("看 https://example.com/a?b=1 好!!!!!!  讚", "看  好  讚"),
    ("aaaaab\n\n\n\n\nccc", "aab\n\n\n\n\nccc"),
    ("　 全形空白   nbsp\x1c", "全形空白   nbsp"),
    ("數字１２３ and ٣٤٥ digits", "數字１２３ and ٣٤٥ digits"),
    ("a.b,c", "a b c"),
    ("", ""),
    ("____x____", "__x__"),
]


@pytest.mark.parametrize("text, cleaned", CLEAN_CASES)
def test_clean_text_gives_stated_results(spark, text, cleaned):
    assert one(spark, X.clean_text, text) == cleaned


def test_strip_unicode_whitespace(spark):
    assert one(spark, X.strip, "　\x1d a b  \n") == "a b"


def test_has_text(spark):
    df = spark.createDataFrame([("x",), ("NA",), ("",), (None,), ("nan",), (" ",)], "v string")
    got = [r[0] for r in df.select(X.has_text("v")).collect()]
    assert got == [True, False, False, False, False, True]


def test_article_body_cuts_signature_and_squeezes(spark):
    text = "  hello\n\n\n\nworld\n-- \nsig line\nmore\n--\nagain"
    assert one(spark, X.article_body, text) == "hello\n\nworld"
    assert one(spark, X.article_body, "no signature\n\n\n") == "no signature"


def test_sample_text(spark):
    assert one(spark, X.sample_text, "a\nb") == "a b"
    long = "字" * 100
    assert one(spark, X.sample_text, long) == "字" * 80


def test_tokenize_with_cjk_bigrams(spark):
    df = spark.createDataFrame([("台積電 漲 Apple a",)], "v string")
    got = df.select(X.tokenize("v", cjk_bigrams=True).alias("t")).first()["t"]
    assert got == ["台積電", "apple", "台積", "積電"]


def test_roc_to_iso(spark):
    assert one(spark, M.roc_to_iso, "1150410") == "2026-04-10"
    assert one(spark, M.roc_to_iso, " 0991231 ") == "2010-12-31"
    assert one(spark, M.roc_to_iso, " 20250101 ") == "20250101"
    assert one(spark, M.roc_to_iso, "") == ""


@pytest.mark.parametrize("text,expected", [
    ("1,234.5", 1234.5), (" 12 ", 12.0), ("--", None), ("----", None), ("N/A", None),
    ("", None), ("abc", None), ("1.5d", None), ("-0.28", -0.28), ("1e3", 1000.0),
])
def test_to_number(spark, text, expected):
    assert one(spark, M.to_number, text) == expected


def test_quote_texts_docstring_examples(spark):
    df = spark.createDataFrame([(80.8, 1.6), (10.0, -0.28), (5.0, 5.0), (None, 1.0), (3.0, None)],
                               "c double, d double")
    chg, pct = M.quote_texts("c", "d")
    got = [tuple(r) for r in df.select(chg, pct).collect()]
    assert got == [("+1.60", "+2.02%"), ("-0.28", "-2.72%"), ("+5.00", ""), ("", ""), ("", "")]


def test_to_volume_truncates(spark):
    assert one(spark, M.to_volume, 1234.9, "double") == 1234
    assert one(spark, M.to_volume, -2.5, "double") == -2


def test_post_date(spark):
    df = spark.createDataFrame([("2/29",), ("12/3",), ("",), ("13/1",), (" 1/5 ",)], "d string")
    got = [r[0] for r in df.select(M.post_date("d", 2023)).collect()]
    assert got == [None, dt.datetime(2023, 12, 3), None, None, dt.datetime(2023, 1, 5)]
    assert one(spark, lambda c: M.post_date(c, 2024), "2/29") == dt.datetime(2024, 2, 29)


def test_chain_topic_and_segment_code(spark):
    assert one(spark, M.chain_topic, "  半導體 產業鏈簡介 ") == "半導體"
    assert one(spark, M.chain_topic, "ABC") == "ABC"
    assert one(spark, M.segment_code, "companyList_A1B") == "A1B"
    assert one(spark, M.segment_code, "companyList_x-1") == "x-1"


def test_keyword_list(spark):
    df = spark.createDataFrame([("2330", "台積電", "TSMC, 台積 ,,TSMC"), ("50", " ", None)],
                               "code string, name string, alias string")
    got = [r[0] for r in df.select(keyword_list("code", "name", "alias")).collect()]
    assert got == [["台積電", "2330", "TSMC", "台積"], ["50"]]


def test_resolve_code(spark):
    df = spark.createDataFrame([("24",), (" 01 ",), ("91",), ("",)], "c string")
    got = [r[0] for r in df.select(resolve_code("c")).collect()]
    assert got == ["半導體業", "水泥工業", "91", ""]
