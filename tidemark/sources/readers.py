"""Sources: articles CSV, stock CSV, landed JSON feeds, label maps, pages, stage tables.

Every reader declares its schema (no inference).  A feed that may legitimately be
absent is read with ``required=False`` and then yields an empty, typed DataFrame.
"""

from __future__ import annotations

import sys

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import (LIST_VOCAB_EN, LIST_VOCAB_ZH, QUOTE_VOCAB_EXCHANGE,
                               QUOTE_VOCAB_OTC)
from ..functions.text import strip

ARTICLE_CSV_SCHEMA = T.StructType([
    T.StructField("stock_id", T.StringType()),
    T.StructField("ArticleTitle", T.StringType()),
    T.StructField("ArticleText", T.StringType()),
    T.StructField("ArticleCreateTime", T.StringType()),
])

PAGES_SCHEMA = "page_id long, url string, html string"


def vocab_schema(vocab: dict) -> T.StructType:
    return T.StructType([T.StructField(v, T.StringType()) for v in vocab.values()])


SCHEMAS = {
    "list_zh": vocab_schema(LIST_VOCAB_ZH),
    "list_en": vocab_schema(LIST_VOCAB_EN),
    "quote_exchange": vocab_schema(QUOTE_VOCAB_EXCHANGE),
    "quote_otc": vocab_schema(QUOTE_VOCAB_OTC),
}


def read_source(spark: SparkSession, path: str, schema, fmt: str = "json",
                required: bool = True, **options) -> DataFrame:
    """A landed feed.  A missing optional feed gives no rows (with a warning)
    instead of failing the job; a missing required feed raises."""
    reader = spark.read.schema(schema).options(**options)
    try:
        df = reader.format(fmt).load(path)
        df.schema  # path resolution happens here
        return df
    except AnalysisException as e:
        if required or e.getCondition() != "PATH_NOT_FOUND":
            raise
        print(f"warning: optional source {path} is missing", file=sys.stderr)
        return spark.createDataFrame([], schema)


def read_json_records(spark: SparkSession, path: str, schema, required: bool = True) -> DataFrame:
    """Landed JSON arrays of records (one array per file), in record order.

    ``ordinal`` is the file's path and the record's place in its array, so it does not
    depend on how files are dealt to tasks.  A file that is no such array fails the job.
    """
    files = read_source(spark, path, "value string", "text", required, wholetext=True)
    records = F.from_json("value", T.ArrayType(schema), {"mode": "FAILFAST"})
    rows = files.select("value", F.input_file_name().alias("__file")).select("__file", F.posexplode(records).alias("__pos", "__r"))
    return rows.select("__r.*", F.concat_ws("#", "__file", F.lpad(F.col("__pos").cast("string"), 12, "0")).alias("ordinal"))


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Article CSV (header, UTF-8 with BOM, quoted multi-line text)."""
    df = (spark.read.schema(ARTICLE_CSV_SCHEMA)
          .options(header=True, multiLine=True, escape='"', encoding="UTF-8")
          .csv(path))
    return df.select(
        strip("stock_id").alias("stock_id"), F.col("ArticleTitle").alias("title"),
        F.col("ArticleText").alias("text"),
        F.try_to_timestamp(F.col("ArticleCreateTime")).alias("created_at"))


def read_stocks(spark: SparkSession, path: str, columns=("stock_code", "stock_id", "stock_name",
                                                           "stock_alias", "industry_name")) -> DataFrame:
    """Stock CSV with every column as string and missing values as ""."""
    header = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    df = spark.read.schema(schema).options(header=True, encoding="UTF-8").csv(path)
    return df.na.fill("")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """{level: {cluster id: label}} JSON -> (level, cluster int, label).  Raises if absent."""
    raw = spark.read.text(path, wholetext=True)
    return labels_from_json(raw, "value")


def labels_from_json(df: DataFrame, col: str) -> DataFrame:
    m = F.from_json(F.col(col), "map<string, map<string, string>>")
    lv = df.select(F.explode(m).alias("level", "__m"))
    out = lv.select("level", F.explode("__m").alias("__k", "label"))
    return out.select("level", F.col("__k").try_cast("int").alias("cluster"), "label")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed raw pages (page_id, url, html)."""
    return spark.read.schema(PAGES_SCHEMA).parquet(path)


def read_stage(spark: SparkSession, root: str, run: str, name: str) -> DataFrame:
    """Reload a stage written by ``sinks.write_stage``."""
    return spark.read.parquet(f"{root.rstrip('/')}/{run}/{name}")
