"""Sources and sinks (S1-S10, K1-K8) as round trips in a fresh temp folder."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators.dims import choose_id_column, stock_dimension, with_industry
from tidemark.sources import readers as R
from tidemark.sources import sinks as K


def write(path, text, bom=False):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        f.write(text)
    return path


def test_read_articles_bom_multiline(spark, scratch):
    p = write(os.path.join(scratch, "a.csv"),
              'stock_id,ArticleTitle,ArticleText,ArticleCreateTime\n'
              '0050,"t1","line one\nline ""two""",2026-04-10 08:00:00\n'
              '2330,t2,,not a time\n', bom=True)
    rows = R.read_articles(spark, p).orderBy("stock_id").collect()
    assert rows[0]["stock_id"] == "0050" and rows[0]["text"] == 'line one\nline "two"'
    assert rows[0]["created_at"] == dt.datetime(2026, 4, 10, 8, 0)
    assert rows[1]["text"] is None and rows[1]["created_at"] is None


def test_read_stocks_and_id_choice(spark, scratch):
    p = write(os.path.join(scratch, "s.csv"), "stock_id,stock_name,industry_name\n2330,台積電,\n2303,,半導體業\n")
    df = R.read_stocks(spark, p)
    assert choose_id_column(df) == "stock_id"
    assert sorted(tuple(r) for r in df.collect()) == [("2303", "", "半導體業"), ("2330", "台積電", "")]
    with pytest.raises(ValueError):
        choose_id_column(df.drop("stock_id"))


def test_with_industry_last_row_wins_and_default(spark):
    stocks = spark.createDataFrame([("1", "A", 0), ("1", "B", 1), ("2", None, 0)],
                                   "stock_code string, industry_name string, ord int")
    arts = spark.createDataFrame([("1",), ("2",), ("3",)], "stock_id string")
    got = sorted(tuple(r) for r in with_industry(arts, stocks, order="ord").collect())
    assert got == [("1", "B"), ("2", "其他"), ("3", "其他")]
    assert stock_dimension(stocks, "ord").count() == 2


def test_read_labels_and_missing_raises(spark, scratch):
    p = write(os.path.join(scratch, "labels.json"),
              json.dumps({"fine": {"1": "晶圓", "2": "記憶體"}, "medium": {"1": "半導體"}}, ensure_ascii=False))
    got = sorted(tuple(r) for r in R.read_labels(spark, p).collect())
    assert got == [("fine", 1, "晶圓"), ("fine", 2, "記憶體"), ("medium", 1, "半導體")]
    with pytest.raises(AnalysisException):
        R.read_labels(spark, os.path.join(scratch, "absent.json")).collect()


def test_read_source_optional_and_required(spark, scratch):
    schema = R.SCHEMAS["quote_otc"]
    empty = R.read_source(spark, os.path.join(scratch, "none"), schema, required=False)
    assert empty.count() == 0 and empty.schema == schema
    with pytest.raises(AnalysisException):
        R.read_source(spark, os.path.join(scratch, "none"), schema, required=True)
    p = write(os.path.join(scratch, "q.json"),
              json.dumps([{"SecuritiesCompanyCode": "6488", "Close": "1,234.5", "Change": "--",
                           "TradingShares": "1000", "Date": "1150410"}]))
    recs = R.read_json_records(spark, p, schema).collect()
    assert recs[0]["Close"] == "1,234.5" and recs[0]["ordinal"].endswith("q.json#000000000000")


def test_json_records_keep_file_and_array_order(spark, scratch):
    schema = R.SCHEMAS["quote_otc"]
    record = lambda code: {"SecuritiesCompanyCode": code}
    os.mkdir(os.path.join(scratch, "feed"))
    write(os.path.join(scratch, "feed", "b.json"), json.dumps([record(f"b{i}") for i in range(50)], indent=1))
    write(os.path.join(scratch, "feed", "a.json"), json.dumps([record("a0")]))
    recs = R.read_json_records(spark, os.path.join(scratch, "feed"), schema).orderBy("ordinal").collect()
    assert [r["SecuritiesCompanyCode"] for r in recs] == ["a0", *[f"b{i}" for i in range(50)]]
    write(os.path.join(scratch, "feed", "c.json"), "[{]")
    with pytest.raises(Exception, match="MALFORMED|malformed|PARSE"):
        R.read_json_records(spark, os.path.join(scratch, "feed"), schema).collect()


def test_stage_result_json_and_overwrite(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    path = K.write_stage(df, scratch, "run1", "docs")
    assert sorted(tuple(r) for r in R.read_stage(spark, scratch, "run1", "docs").collect()) == [(1, "a"), (2, "b")]
    K.write_result(df, os.path.join(scratch, "csv"), "csv")
    back = spark.read.option("header", True).csv(os.path.join(scratch, "csv"))
    assert back.columns == ["id", "v"] and back.count() == 2
    K.write_json(df, os.path.join(scratch, "json"), loaded_at="2026-04-10T00:00:00")
    j = spark.read.json(os.path.join(scratch, "json"))
    assert set(j.columns) == {"id", "v", "scraped_at"}
    K.overwrite_table(df, os.path.join(scratch, "tbl"), cluster_by=["v"])
    K.overwrite_table(df.where(F.col("id") == 1), os.path.join(scratch, "tbl"))
    assert spark.read.parquet(os.path.join(scratch, "tbl")).count() == 1
    assert path.endswith("run1/docs")


def test_records_land_in_order_and_are_read_in_order(spark, scratch):
    from tidemark.sources import readers, sinks
    rows = [(i, f"c{i}", None if i % 5 == 0 else f"n\"{i}") for i in range(95)]
    df = spark.createDataFrame(rows, "ordinal long, code string, name string").repartition(7)
    path = sinks.land_records(df, "ordinal", f"{scratch}/feed", per_file=10)
    got = readers.read_json_records(spark, path, df.select("code", "name").schema).orderBy("ordinal").collect()
    assert [(r["code"], r["name"]) for r in got] == [r[1:] for r in rows]
    assert len({r["ordinal"].split("#")[0] for r in got}) == 10
