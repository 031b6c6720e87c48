"""Dimension lookups: code -> name maps, article -> industry, chain -> category.

Small fixed maps are map literals (a pure expression, no join at all).  Data-driven
dimensions are joined without a hint: Spark broadcasts a side by its size in bytes, before
the run or from the shuffle's real sizes, and splits skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import DEFAULT_INDUSTRY, INDUSTRY_CODE_MAP
from ..functions.text import strip
from .dedupe import last_wins


def map_literal(mapping: dict[str, str]) -> Column:
    items: list[Column] = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def resolve_code(code, mapping: dict[str, str] | None = None) -> Column:
    """Code -> name through a fixed map; an unknown code returns the code itself."""
    c = strip(F.col(code) if isinstance(code, str) else code)
    m = map_literal(INDUSTRY_CODE_MAP if mapping is None else mapping)
    return F.coalesce(F.try_element_at(m, c), c)


def resolve_code_join(df: DataFrame, code: str, dim: DataFrame, dim_code: str,
                      dim_name: str, out: str) -> DataFrame:
    """P6 against a data-driven code table (one name per code, first by name)."""
    d = (dim.select(strip(F.col(dim_code)).alias("__code"), F.col(dim_name).alias("__name"))
         .groupBy("__code").agg(F.min("__name").alias("__name")))
    j = df.withColumn("__code", strip(F.col(code))).join(d, "__code", "left")
    return j.withColumn(out, F.coalesce(F.col("__name"), F.col("__code"))).drop("__code", "__name")


def choose_id_column(df: DataFrame, candidates: Iterable[str] = ("stock_code", "stock_id")) -> str:
    """S3: the first id column present, else ValueError."""
    for c in candidates:
        if c in df.columns:
            return c
    raise ValueError(f"none of {list(candidates)} in columns {df.columns}")


def stock_dimension(stocks: DataFrame, order: str, industry: str = "industry_name") -> DataFrame:
    """(stock_code, industry_name) with one row per code: the last row by ``order`` wins."""
    idc = choose_id_column(stocks)
    s = stocks.select(strip(F.col(idc)).alias("stock_code"), F.col(industry).alias("industry_name"),
                      F.col(order).alias("__ord"))
    return last_wins(s, ["stock_code"], ["__ord"]).drop("__ord")


def with_industry(articles: DataFrame, stocks: DataFrame, stock_col: str = "stock_id",
                  default: str = DEFAULT_INDUSTRY, *, order: str) -> DataFrame:
    """Article left-join stock on code; a missing industry becomes ``default``."""
    dim = stock_dimension(stocks, order)
    j = articles.join(dim, articles[stock_col] == dim["stock_code"], "left")
    return j.withColumn("industry_name", F.coalesce(F.col("industry_name"), F.lit(default))) \
            .drop("stock_code")


def keyword_list(code, name, alias) -> Column:
    """[name, code, aliases split on ","], trimmed, blanks dropped, first-seen distinct."""
    def col(c):
        return F.col(c) if isinstance(c, str) else c
    aliases = F.transform(F.split(F.coalesce(col(alias), F.lit("")), ","), strip)
    words = F.concat(F.array(strip(F.coalesce(col(name), F.lit(""))),
                             strip(F.coalesce(col(code), F.lit("")))), aliases)
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def with_category(df: DataFrame, index: DataFrame, key: str = "chain_ic",
                  category: str = "major_industry") -> DataFrame:
    """Chain id -> category; a chain missing from the index gets ""."""
    j = df.join(index.select(key, category), key, "left")
    return j.withColumn(category, F.coalesce(F.col(category), F.lit("")))


def chain_order(df: DataFrame, key: str = "chain_ic") -> DataFrame:
    """O1: rank of each distinct chain id by (length, value).

    The ranking window has no partition key, so it runs over the distinct ids only
    (dimension-sized), never over the rows.
    """
    from pyspark.sql import Window
    ids = df.select(key).distinct()
    w = Window.orderBy(F.length(key).asc_nulls_last(), F.col(key).asc_nulls_last())
    return ids.withColumn("chain_order", F.row_number().over(w))
