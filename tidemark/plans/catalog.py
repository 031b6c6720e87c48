"""Registered queries: key -> (spark, sf_dir) -> DataFrame, with DuckDB oracle SQL.

Each query runs one or more operators of the package over the driver tables (whole
tables, no row caps).  ``ORACLE`` holds an independent SQL formulation for every
query whose result SQL can state; the others are checked by property tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import DEFAULT_INDUSTRY
from ..functions.text import clean_text, has_text, strip
from ..operators import rollup, segment
from ..session import scratch_path, staged
from ..sources.tables import read_table, spread
from . import sqlparts as S
from .standins import articles, both_levels, kept_docs, topic_docs

#: The languages of the documents, which stand in for the industry dimension.
LANGS = ("de", "en", "es", "fr")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


# ---------------------------------------------------------------- topic x industry (A3)
@register("topic_industry_matrix", f"""
WITH {S.topic_docs_ctes()}, {S.both_levels_cte()}
SELECT level, topic,
       * EXCLUDE (level, topic, total), total
FROM (PIVOT tl ON lang IN ({", ".join(S.q(x) for x in LANGS)}) USING count(*) GROUP BY level, topic)
JOIN (SELECT level, topic, count(lang) AS total FROM tl
      WHERE lang IN ({", ".join(S.q(x) for x in LANGS)}) GROUP BY level, topic) USING (level, topic)""")
def topic_industry_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per (level, topic) x language, with a total."""
    return rollup.topic_matrix(both_levels(topic_docs(spark, sf_dir)), ["level", "topic"], "lang", LANGS)


# ---------------------------------------------------------------- cleaning
_ctes, _name = S.clean_ctes(f"(SELECT doc_id, text FROM documents WHERE {S.HAS_TEXT})", "doc_id", "text")


@register("clean_text", f"WITH {_ctes}\nSELECT doc_id, clean FROM {_name}")
def clean_text_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept documents with cleaned text."""
    d = spread(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return d.where(has_text("text")).select("doc_id", clean_text(strip("text")).alias("clean"))


# ---------------------------------------------------------------- profile (A1, O3)
@register("corpus_profile", f"""
SELECT count(*) AS n_rows, count(DISTINCT source) AS n_stocks,
       count(DISTINCT lang) AS n_industries,
       (SELECT list(lang ORDER BY lang) FROM (SELECT DISTINCT lang FROM documents
         WHERE {S.HAS_TEXT} AND lang IS NOT NULL)) AS industries
FROM documents WHERE {S.HAS_TEXT}""")
def corpus_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, O3: rows, distinct stocks, distinct industries and the sorted industry list."""
    return rollup.corpus_profile(articles(spark, sf_dir), "stock_id", "lang")


@register("industry_counts", f"""
SELECT lang, count(*) AS n FROM documents WHERE {S.HAS_TEXT} GROUP BY lang""")
def industry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: articles per industry, descending."""
    return rollup.industry_counts(articles(spark, sf_dir), "lang")


# ================================================================ market data
from ..functions.fixed import (INDUSTRY_CODE_MAP, LIST_VOCAB_EN, LIST_VOCAB_ZH,  # noqa: E402
                               MARKET_EMERGING, MARKET_LISTED, MARKET_OTC, QUOTE_VOCAB_EXCHANGE,
                               QUOTE_VOCAB_OTC)
from ..functions.market import (chain_topic, post_date as post_date_fn, quote_texts,  # noqa: E402
                                roc_to_iso, segment_code)
from ..operators import dedupe, dims, market  # noqa: E402

SYNCED_AT = "2026-04-13T18:00:00+0800"
AS_OF = "1150410"

_CODE_MAP_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"({S.q(k)}, {S.q(v)})" for k, v in INDUSTRY_CODE_MAP.items()) + ") AS m(code, name)"


def _landed_lists(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three company lists as landed JSON records: customer (Chinese field names),
    supplier and part (English field names); their keys overlap."""
    zh, en = LIST_VOCAB_ZH, LIST_VOCAB_EN
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias(zh["code"]),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(""))
         .when(F.col("c_mktsegment") == "MACHINERY", F.lit(" "))
         .otherwise(F.col("c_name")).alias(zh["short"]),
        F.col("c_mktsegment").alias(zh["full"]),
        F.lit(AS_OF).alias(zh["as_of"]),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias(zh["industry"]),
        F.col("c_custkey").alias("ordinal"))
    s = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias(en["code"]),
        F.col("s_name").alias(en["short"]),
        F.lit(None).cast("string").alias(en["full"]),
        F.lit(AS_OF).alias(en["as_of"]),
        F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias(en["industry"]),
        F.col("s_suppkey").alias("ordinal"))
    p = read_table(spark, sf_dir, "part").select(
        F.concat(F.lit(" "), F.col("p_partkey").cast("string")).alias(en["code"]),
        F.lit(None).cast("string").alias(en["short"]),
        F.col("p_name").alias(en["full"]),
        F.lit(AS_OF).alias(en["as_of"]),
        F.col("p_size").cast("string").alias(en["industry"]),
        F.col("p_partkey").alias("ordinal"))
    return [market.company_list(_landed(c, "list_zh"), zh, MARKET_LISTED, "list:listed", SYNCED_AT),
            market.company_list(_landed(s, "list_en"), en, MARKET_OTC, "list:otc", SYNCED_AT),
            market.company_list(_landed(p, "list_en"), en, MARKET_EMERGING, "list:emerging", SYNCED_AT)]


def _landed(records: DataFrame, feed: str) -> DataFrame:
    """The records landed as JSON arrays in the order of their ``ordinal``, and read again in file and array order."""
    from ..sources import readers, sinks
    path = sinks.land_records(records, "ordinal", scratch_path(records.sparkSession, feed))
    return readers.read_json_records(records.sparkSession, path, readers.SCHEMAS[feed])


@register("company_list", f"""
WITH raw AS (
  SELECT CAST(c_custkey AS VARCHAR) AS code,
         CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN ' ' ELSE c_name END AS short,
         c_mktsegment AS full_name, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS ind,
         '{MARKET_LISTED}' AS market, 'list:listed' AS source_url, 0 AS prio, c_custkey AS ord FROM customer
  UNION ALL
  SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, lpad(CAST(s_nationkey AS VARCHAR), 2, '0'),
         '{MARKET_OTC}', 'list:otc', 1, s_suppkey FROM supplier
  UNION ALL
  SELECT ' ' || CAST(p_partkey AS VARCHAR), NULL, p_name, CAST(p_size AS VARCHAR),
         '{MARKET_EMERGING}', 'list:emerging', 2, p_partkey FROM part),
m AS ({_CODE_MAP_SQL}),
n AS (
  SELECT {S.strip_sql("code")} AS stock_code,
         {S.strip_sql("CASE WHEN short IS NOT NULL AND short <> '' THEN short ELSE coalesce(full_name, '') END")} AS stock_name,
         market, {S.strip_sql("ind")} AS industry_code, source_url, prio, ord FROM raw),
k AS (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY prio, ord) AS rn
      FROM n WHERE stock_code <> '' AND stock_name <> '')
SELECT stock_code, stock_name, market, industry_code, coalesce(m.name, industry_code) AS industry_name,
       source_url, '{AS_OF}' AS source_as_of, '{SYNCED_AT}' AS synced_at, CAST(prio AS INTEGER) AS priority
FROM k LEFT JOIN m ON k.industry_code = m.code WHERE rn = 1""")
def company_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three company lists -> one stock list, first seen wins."""
    return market.first_seen(_landed_lists(spark, sf_dir))


@register("industry_lookup", f"""
WITH dim AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS stock_code, coalesce(n.n_name, CAST(s_nationkey AS VARCHAR)) AS industry_name,
         row_number() OVER (PARTITION BY CAST(s_suppkey AS VARCHAR) ORDER BY s_suppkey DESC) AS rn
  FROM supplier s LEFT JOIN (SELECT n_nationkey, min(n_name) AS n_name FROM nation GROUP BY 1) n
    ON s.s_nationkey = n.n_nationkey)
SELECT e.event_id, CAST(e.user_id AS VARCHAR) AS stock_id,
       coalesce(dim.industry_name, '{DEFAULT_INDUSTRY}') AS industry_name
FROM events e LEFT JOIN dim ON CAST(e.user_id AS VARCHAR) = dim.stock_code AND dim.rn = 1""")
def industry_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events (as articles) left-join a stock dimension; missing -> default."""
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    sup = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    stocks = dims.resolve_code_join(
        sup.select(F.col("s_suppkey").cast("string").alias("stock_code"),
                   F.col("s_nationkey").cast("string").alias("code"), "s_suppkey"),
        "code", nation, "n_nationkey", "n_name", "industry_name")
    ev = read_table(spark, sf_dir, "events", "event_id", "user_id").select(
        "event_id", F.col("user_id").cast("string").alias("stock_id"))
    return dims.with_industry(ev, stocks, "stock_id", DEFAULT_INDUSTRY, order="s_suppkey") \
        .select("event_id", "stock_id", "industry_name")


@register("keyword_list", """
WITH p AS (
  SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS name,
         concat_ws(',', p_brand, ' ', p_type, p_brand, ' ' || p_name) AS alias FROM part),
l AS (
  SELECT code, list_concat([""" + S.strip_sql("coalesce(name, '')") + ", " + S.strip_sql("coalesce(code, '')") + """],
         list_transform(string_split(coalesce(alias, ''), ','), lambda x: """ + S.strip_sql("x") + """)) AS w FROM p)
SELECT code AS stock_code,
       array_to_string(list_filter(w, lambda x, i: x <> '' AND list_position(w, x) = i), '|') AS keywords,
       CAST(len(list_filter(w, lambda x, i: x <> '' AND list_position(w, x) = i)) AS INTEGER) AS n_keywords
FROM l""")
def keyword_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search keywords per stock: name, code, then comma-separated aliases."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type").select(
        F.col("p_partkey").cast("string").alias("code"), F.col("p_name").alias("name"),
        F.concat_ws(",", "p_brand", F.lit(" "), "p_type", "p_brand",
                    F.concat(F.lit(" "), F.col("p_name"))).alias("alias"))
    kw = dims.keyword_list("code", "name", "alias")
    return p.select(F.col("code").alias("stock_code"), F.array_join(kw, "|").alias("keywords"),
                    F.size(kw).alias("n_keywords"))


def _sql_number(x: str) -> str:
    s = f"replace({S.strip_sql(x)}, ',', '')"
    return (f"(CASE WHEN {s} IN ('', '--', '----', 'N/A') OR NOT regexp_full_match({s}, "
            f"'[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN NULL "
            f"ELSE TRY_CAST({s} AS DOUBLE) END)")


def _sql_fmt(x: str) -> str:
    return f"((CASE WHEN {x} >= 0 THEN '+' ELSE '' END) || printf('%.2f', {x}))"


def _sql_quote_cols(close: str, change: str, vol: str, date: str) -> str:
    """SELECT list for a cleaned quote, from expressions naming the raw text fields."""
    c, d, v = _sql_number(close), _sql_number(change), _sql_number(vol)
    pct = f"({d} / ({c} - {d}) * 100)"
    s = S.strip_sql(date)
    roc = (f"(CASE WHEN length({s}) = 7 THEN CAST(TRY_CAST(substr({s}, 1, 3) AS INTEGER) + 1911 AS VARCHAR)"
           f" || '-' || substr({s}, 4, 2) || '-' || substr({s}, 6, 2) ELSE {s} END)")
    both = f"({c} IS NOT NULL AND {d} IS NOT NULL)"
    return (f"{c} AS close_price, CASE WHEN {both} THEN {_sql_fmt(d)} ELSE '' END AS change_val, "
            f"CASE WHEN {both} AND ({c} - {d}) <> 0 THEN {_sql_fmt(pct)} || '%' ELSE '' END AS change_pct, "
            f"CAST(trunc({v}) AS BIGINT) AS volume, {roc} AS quote_date")


def _landed_quotes_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = QUOTE_VOCAB_EXCHANGE
    o = spread(read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_totalprice",
                          "o_orderdate", "o_orderpriority"))
    two = lambda x: F.call_function("format_number", x, F.lit("0.00"))
    return o.select(
        F.col("o_orderkey").cast("string").alias(v["code"]),
        F.when(F.col("o_orderstatus") == "P", F.lit("--"))
         .otherwise(F.format_number("o_totalprice", 2)).alias(v["close"]),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("N/A"))
         .otherwise(two(F.col("o_totalprice") / 100000 - 2.5)).alias(v["change"]),
        F.when(F.col("o_orderstatus") == "F", F.lit(""))
         .otherwise(F.format_number(F.floor(F.col("o_totalprice") * 10), 0)).alias(v["volume"]),
        F.when(F.col("o_orderpriority") == "1-URGENT",
               F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-MM-dd")))
         .otherwise(F.concat(F.lpad((F.year("o_orderdate") - 1911).cast("string"), 3, "0"),
                             F.date_format("o_orderdate", "MMdd"))).alias(v["date"]),
        F.col("o_orderkey").alias("ordinal"))


@register("quote_clean", f"""
WITH raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS code,
         CASE WHEN o_orderstatus = 'P' THEN '--' ELSE format('{{:,.2f}}', o_totalprice) END AS close_t,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'N/A' ELSE printf('%.2f', o_totalprice / 100000 - 2.5) END AS change_t,
         CASE WHEN o_orderstatus = 'F' THEN '' ELSE format('{{:,}}', CAST(floor(o_totalprice * 10) AS BIGINT)) END AS vol_t,
         CASE WHEN o_orderpriority = '1-URGENT' THEN ' ' || strftime(o_orderdate, '%Y-%m-%d')
              ELSE lpad(CAST(year(o_orderdate) - 1911 AS VARCHAR), 3, '0') || strftime(o_orderdate, '%m%d') END AS date_t
  FROM orders)
SELECT {S.strip_sql("code")} AS stock_code, {_sql_quote_cols("close_t", "change_t", "vol_t", "date_t")}
FROM raw WHERE {S.strip_sql("code")} <> ''""")
def quote_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed quote texts -> typed close, change text, change %, volume, ISO date."""
    landed = _landed(_landed_quotes_orders(spark, sf_dir), "quote_exchange")
    return market.clean_quotes(landed, QUOTE_VOCAB_EXCHANGE).drop("ordinal")


def _roc_of(ts: str) -> F.Column:
    return F.concat(F.lpad((F.year(ts) - 1911).cast("string"), 3, "0"), F.date_format(ts, "MMdd"))


_ROC_SQL = "lpad(CAST(year(ts) - 1911 AS VARCHAR), 3, '0') || strftime(ts, '%m%d')"


#: Event types with a feed of their own; all others are the third feed.
_OWN_FEED = ("click", "view")


def _events_feed(spark: SparkSession, sf_dir: str, event_type: str | None, vocab: dict,
                 signed_change: bool) -> DataFrame:
    """Landed quote records of one event type, or of all without a feed of their own."""
    e = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    two = lambda x: F.call_function("format_number", x, F.lit("0.00"))
    chg = F.col("value") / 10 - 1
    chg_t = F.concat(F.when(chg > 0, F.lit("+")).otherwise(F.lit("")), two(chg)) if signed_change else two(chg)
    own = ~F.coalesce(F.col("event_type").isin(*_OWN_FEED), F.lit(False)) if event_type is None else F.col("event_type") == event_type
    return e.where(own).select(
        F.col("user_id").cast("string").alias(vocab["code"]),
        two(F.col("value")).alias(vocab["close"]),
        chg_t.alias(vocab["change"]),
        (F.col("event_id") * 100).cast("string").alias(vocab["volume"]),
        _roc_of("ts").alias(vocab["date"]),
        F.lpad(F.col("event_id").cast("string"), 20, "0").alias("ordinal"))


def _sql_feed(event_type: str | None, prio: int, signed: bool) -> str:
    chg = "printf('%.2f', value / 10 - 1)"
    if signed:
        chg = f"(CASE WHEN value / 10 - 1 > 0 THEN '+' ELSE '' END) || {chg}"
    return (f"SELECT CAST(user_id AS VARCHAR) AS code, printf('%.2f', value) AS close_t, {chg} AS change_t, "
            f"CAST(event_id * 100 AS VARCHAR) AS vol_t, {_ROC_SQL} AS date_t, {prio} AS prio, event_id AS ord "
            + (f"FROM events WHERE event_type = '{event_type}'" if event_type else
               f"FROM events WHERE event_type IS NULL OR event_type NOT IN {_OWN_FEED}"))


@register("quote_merge", f"""
WITH raw AS ({_sql_feed('click', 0, False)} UNION ALL {_sql_feed('view', 1, True)}
             UNION ALL {_sql_feed(None, 2, True)}),
q AS (SELECT {S.strip_sql("code")} AS stock_code,
             {_sql_quote_cols("close_t", "change_t", "vol_t", "date_t")}, prio, ord
      FROM raw WHERE {S.strip_sql("code")} <> ''),
r AS (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY prio, ord) AS rn FROM q)
SELECT stock_code, close_price, change_val, change_pct, volume, quote_date, CAST(prio AS INTEGER) AS priority
FROM r WHERE rn = 1""")
def quote_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three quote feeds (two vocabularies) merged, first seen per code wins.

    A fourth, optional feed whose landing folder is absent contributes no rows.
    """
    from ..sources.readers import SCHEMAS, read_json_records
    feeds = [
        market.clean_quotes(_events_feed(spark, sf_dir, "click", QUOTE_VOCAB_EXCHANGE, False),
                            QUOTE_VOCAB_EXCHANGE),
        market.clean_quotes(_events_feed(spark, sf_dir, "view", QUOTE_VOCAB_OTC, True), QUOTE_VOCAB_OTC),
        market.clean_quotes(_events_feed(spark, sf_dir, None, QUOTE_VOCAB_OTC, True), QUOTE_VOCAB_OTC),
    ]
    missing = read_json_records(spark, f"{sf_dir.rstrip('/')}/landing/quotes_optional", SCHEMAS["quote_otc"], required=False)
    feeds.append(market.clean_quotes(missing, QUOTE_VOCAB_OTC))
    return market.first_seen(feeds)


_PCT = "(d / (c - d) * 100)"


@register("quote_update", f"""
WITH ev AS (
  SELECT CAST(user_id AS VARCHAR) AS stock_code, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS c,
         value / 10 - 1 AS d, event_id * 100 AS v, strftime(ts, '%Y-%m-%d') AS qd,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events),
q AS (
  SELECT stock_code, c AS close_price,
         CASE WHEN c IS NOT NULL AND d IS NOT NULL THEN {_sql_fmt('d')} ELSE '' END AS change_val,
         CASE WHEN c IS NOT NULL AND d IS NOT NULL AND c - d <> 0 THEN {_sql_fmt(_PCT)} || '%' ELSE '' END AS change_pct,
         v AS volume, qd AS quote_date
  FROM ev WHERE rn = 1),
b AS (SELECT CAST(c_custkey AS VARCHAR) AS stock_code, c_name AS stock_name, c_acctbal FROM customer)
SELECT b.stock_code, b.stock_name,
       CASE WHEN q.stock_code IS NOT NULL THEN q.close_price ELSE b.c_acctbal END AS close_price,
       CASE WHEN q.stock_code IS NOT NULL THEN q.change_val END AS change_val,
       CASE WHEN q.stock_code IS NOT NULL THEN q.change_pct END AS change_pct,
       CASE WHEN q.stock_code IS NOT NULL THEN q.volume END AS volume,
       CASE WHEN q.stock_code IS NOT NULL THEN q.quote_date END AS quote_date,
       q.stock_code IS NOT NULL AS quote_matched
FROM b LEFT JOIN q ON b.stock_code = q.stock_code""")
def quote_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest quote per code updates matching stock-list rows.

    The list already carries an old close price; the other quote columns are added as
    typed nulls.  Matched rows take every new value (nulls included).
    """
    e = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    ev = e.select(F.col("user_id").cast("string").alias("stock_code"),
                  F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
                   .otherwise(F.col("value")).alias("close_price"),
                  (F.col("value") / 10 - 1).alias("__chg"),
                  (F.col("event_id") * 100).alias("volume"),
                  F.date_format("ts", "yyyy-MM-dd").alias("quote_date"), "ts", "event_id")
    latest = dedupe.last_wins(ev, ["stock_code"], ["ts", "event_id"])
    chg, pct = quote_texts(F.col("close_price"), F.col("__chg"))
    quotes = latest.select("stock_code", "close_price", chg.alias("change_val"), pct.alias("change_pct"),
                           "volume", "quote_date")
    base = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_acctbal").select(
        F.col("c_custkey").cast("string").alias("stock_code"), F.col("c_name").alias("stock_name"),
        F.col("c_acctbal").alias("close_price"))
    return market.update_matched(base, quotes, "stock_code")


POST_YEAR = 2023


@register("post_date", f"""
WITH o AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN ''
              ELSE strftime(o_orderdate, '%-m/%-d') END AS post_text FROM orders)
SELECT o_orderkey, post_text,
       strftime(try_strptime('{POST_YEAR}/' || {S.strip_sql('post_text')}, '%Y/%m/%d'), '%Y-%m-%d %H:%M:%S') AS created_at
FROM o""")
def post_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Post dates ``M/D`` plus a year parameter; invalid dates (2/29, "") -> null."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    o = o.select("o_orderkey", F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"),
                                      F.lit("")).otherwise(F.date_format("o_orderdate", "M/d")).alias("post_text"))
    return o.select("o_orderkey", "post_text",
                    F.date_format(post_date_fn("post_text", POST_YEAR), "yyyy-MM-dd HH:mm:ss").alias("created_at"))


_SUFFIX = "產業鏈簡介"


@register("chain_rows", f"""
WITH raw AS (
  SELECT replace(p.p_brand, 'Brand#', 'B') AS chain_ic,
         p.p_type || CASE WHEN l.l_returnflag = 'R' THEN ' {_SUFFIX} ' ELSE '' END AS title,
         'companyList_' || CASE WHEN l.l_linestatus = 'O' THEN lower(p.p_type) ELSE p.p_type END AS div_id,
         p.p_type AS segment_name, l.l_returnflag AS listing_bucket,
         CAST(s.s_suppkey AS VARCHAR) AS stock_code, s.s_name AS stock_name, l.l_orderkey, l.l_linenumber
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey),
t AS (
  SELECT *, {S.strip_sql('title')} AS tt,
         CASE WHEN regexp_matches(div_id, '^companyList_[0-9A-Z]')
              THEN regexp_extract(div_id, '^companyList_([0-9A-Z]+)', 1)
              ELSE replace(div_id, 'companyList_', '') END AS segment_code
  FROM raw),
u AS (
  SELECT *, CASE WHEN ends_with(tt, '{_SUFFIX}') THEN {S.strip_sql(f"substring(tt, 1, length(tt) - {len(_SUFFIX)})")}
                 ELSE tt END AS chain_topic,
         row_number() OVER (PARTITION BY chain_ic, segment_code, stock_code, listing_bucket
                            ORDER BY l_orderkey DESC, l_linenumber DESC) AS rn
  FROM t),
idx AS (
  SELECT chain_ic, p_type AS major_industry FROM (
    SELECT replace(p_brand, 'Brand#', 'B') AS chain_ic, p_type,
           row_number() OVER (PARTITION BY replace(p_brand, 'Brand#', 'B') ORDER BY p_partkey DESC) AS rn
    FROM part) WHERE rn = 1),
k AS (SELECT * FROM u WHERE rn = 1)
SELECT coalesce(idx.major_industry, '') AS major_industry, k.chain_ic,
       CAST(dense_rank() OVER (ORDER BY length(k.chain_ic), k.chain_ic) AS INTEGER) AS chain_order,
       chain_topic, segment_code, segment_name, listing_bucket, stock_code, stock_name
FROM k LEFT JOIN idx ON k.chain_ic = idx.chain_ic""")
def chain_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain rows keyed (chain, segment, stock, bucket), last wins,
    with the chain's category from an index (later index hits replace earlier ones)."""
    li = spread(read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey",
                           "l_suppkey", "l_returnflag", "l_linestatus"))
    pt = read_table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type")
    sp = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    raw = (li.join(pt, li.l_partkey == pt.p_partkey).join(sp, li.l_suppkey == sp.s_suppkey)
           .select(F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("B")).alias("chain_ic"),
                   chain_topic(F.concat(F.col("p_type"), F.when(F.col("l_returnflag") == "R",
                                                               F.lit(f" {_SUFFIX} ")).otherwise(F.lit(""))))
                   .alias("chain_topic"),
                   segment_code(F.concat(F.lit("companyList_"),
                                         F.when(F.col("l_linestatus") == "O", F.lower("p_type"))
                                          .otherwise(F.col("p_type")))).alias("segment_code"),
                   F.col("p_type").alias("segment_name"), F.col("l_returnflag").alias("listing_bucket"),
                   F.col("s_suppkey").cast("string").alias("stock_code"), F.col("s_name").alias("stock_name"),
                   "l_orderkey", "l_linenumber"))
    rows = dedupe.last_wins(raw, ["chain_ic", "segment_code", "stock_code", "listing_bucket"],
                            ["l_orderkey", "l_linenumber"]).drop("l_orderkey", "l_linenumber")
    index = dedupe.last_wins(
        pt.select(F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("B")).alias("chain_ic"),
                  F.col("p_type").alias("major_industry"), "p_partkey"),
        ["chain_ic"], ["p_partkey"]).drop("p_partkey")
    # The chains in use need two columns of the joined rows only.  Order and category are
    # staged as one table of chains, whose known size lets the rows meet it unshuffled.
    used = li.select("l_partkey", "l_suppkey").join(pt.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).join(
        sp.select("s_suppkey"), F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
    order = dims.chain_order(used.select(F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("B")).alias("chain_ic")), "chain_ic")
    chain = staged(dims.with_category(order, index, "chain_ic", "major_industry").withColumnRenamed("chain_ic", "__ic"), "chains")
    return rows.join(chain, F.col("chain_ic").eqNullSafe(F.col("__ic"))).select(
        "major_industry", "chain_ic", "chain_order", "chain_topic", "segment_code", "segment_name",
        "listing_bucket", "stock_code", "stock_name")


# ================================================================ dedupe / top-k / resume
from ..functions.fixed import MAX_PER_STOCK  # noqa: E402


@register("top_n_per_group", f"""
SELECT event_id, user_id, event_type, CAST(rn AS INTEGER) AS rank FROM (
  SELECT event_id, user_id, event_type,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events)
WHERE rn <= {MAX_PER_STOCK}""")
def top_n_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first N hits per (stock, board) in search order."""
    e = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    return dedupe.top_n(e, ["user_id", "event_type"], ["ts", "event_id"], MAX_PER_STOCK) \
        .select("event_id", "user_id", "event_type", "rank")


@register("url_claim", """
SELECT url, stock_id, doc_id FROM (
  SELECT sha256(text) AS url, source AS stock_id, doc_id,
         row_number() OVER (PARTITION BY sha256(text) ORDER BY source, doc_id) AS rn FROM documents)
WHERE rn = 1""")
def url_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each article URL belongs to the first stock that finds it in the run."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "source").select(
        F.sha2(F.col("text"), 256).alias("url"), F.col("source").alias("stock_id"), "doc_id")
    return dedupe.claim(d, "url", ["stock_id", "doc_id"])


@register("pending_work", """
SELECT doc_id, source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested work minus the done set."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "source")
    done = read_table(spark, sf_dir, "labels", "doc_id")
    return dedupe.pending(d, done, "doc_id")


# ================================================================ article text, briefs, labels, tree
from ..functions.fixed import (FALLBACK_COLOR as _FB, INDUSTRY_PALETTE as _PAL,  # noqa: E402
                               N_KEYWORDS, N_SAMPLES, N_TOP_INDUSTRIES, ROOT_COLOR as _RC,
                               ROOT_ID as _RID, ROOT_LABEL as _RL, SAMPLE_CHARS)
from ..functions.text import WS as _WS, article_body as article_body_fn, tokenize  # noqa: E402
from ..operators import keywords  # noqa: E402

_SIG = "\n-- \nsent from conversation "


@register("article_body", f"""
WITH src AS (
  SELECT 'doc' AS src, doc_id AS id, CAST(0 AS BIGINT) AS turn, text FROM documents
  UNION ALL
  SELECT 'conv', conv_id, turn,
         CASE WHEN role = 'assistant' THEN text || chr(10) || '-- ' || chr(10) || 'sent from conversation '
                                               || CAST(conv_id AS VARCHAR)
              ELSE replace(text, chr(10), repeat(chr(10), 4)) END FROM conversations),
b AS (SELECT src, id, turn,
             regexp_replace(regexp_replace(text, {S.q(rf'(?s)\n--[{_WS}]*\n.*\z')}, ''),
                            '\\n{{3,}}', chr(10) || chr(10), 'g') AS t FROM src)
SELECT src, id, turn, {S.strip_sql('t')} AS body FROM b""")
def article_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article text before the signature line, blank-line runs squeezed, trimmed.

    Conversation turns stand in for fetched articles: assistant turns get a signature
    block appended and user turns get their line breaks widened to four newlines.
    """
    d = read_table(spark, sf_dir, "documents", "doc_id", "text").select(
        F.lit("doc").alias("src"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("turn"), "text")
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").select(
        F.lit("conv").alias("src"), F.col("conv_id").alias("id"), "turn",
        F.when(F.col("role") == "assistant",
               F.concat(F.col("text"), F.lit(_SIG), F.col("conv_id").cast("string")))
         .otherwise(F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n\n\n"))).alias("text"))
    return spread(d.unionByName(c)).select("src", "id", "turn", article_body_fn("text").alias("body"))


def _template_sql(col: str) -> str:
    return (f"(SELECT string_agg('\"' || k || '\":\"\"', ',' ORDER BY k) FROM "
            f"(SELECT DISTINCT CAST({col} AS VARCHAR) AS k FROM td WHERE {col} IS NOT NULL))")


@register("label_template", f"""
WITH {S.topic_docs_ctes()}
SELECT '{{"medium":{{' || {_template_sql("cluster_medium")} || '}},"fine":{{'
       || {_template_sql("cluster_fine")} || '}}}}' AS template""")
def label_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: the label file to fill in: {level: {cluster id: ""}} for every non-empty cluster."""
    td = topic_docs(spark, sf_dir).select(F.col("cluster_medium").alias("medium"),
                                          F.col("cluster_fine").alias("fine"))
    return rollup.label_template(td, ["medium", "fine"])


# A label file as a user writes it after reading the briefs: some clusters left unnamed.
LABELS_JSON = (
    '{"medium": {"0": "medium topic 0", "1": "medium topic 1", "2": "medium topic 2"}, '
    '"fine": {"0": "fine topic 0", "1": "fine topic 1", "2": "fine topic 2", "3": "fine topic 3", '
    '"4": "fine topic 4", "5": "fine topic 5", "6": "fine topic 6", "8": "fine topic 8", '
    '"9": "fine topic 9"}}')


def _labels_sql() -> str:
    import json
    rows = [f"({S.q(lv)}, {int(k)}, {S.q(v)})" for lv, m in json.loads(LABELS_JSON).items() for k, v in m.items()]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS l(level, cluster, label)"


@register("topic_labels", f"""
WITH lab AS ({_labels_sql()}),
v AS (SELECT vec_id, label AS cluster_fine, CAST(floor(label / 3) AS INTEGER) AS cluster_medium FROM embeddings)
SELECT v.vec_id, v.cluster_medium, v.cluster_fine, m.label AS label_medium, f.label AS label_fine
FROM v LEFT JOIN lab m ON m.level = 'medium' AND m.cluster = v.cluster_medium
       LEFT JOIN lab f ON f.level = 'fine' AND f.cluster = v.cluster_fine""")
def topic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster ids -> human labels per level (unmapped -> null)."""
    from ..sources.readers import labels_from_json
    labels = labels_from_json(spark.createDataFrame([(LABELS_JSON,)], "value string"), "value")
    v = read_table(spark, sf_dir, "embeddings", "vec_id", "label").select(
        "vec_id", F.floor(F.col("label") / 3).cast("int").alias("cluster_medium"),
        F.col("label").alias("cluster_fine"))
    return apply_labels(apply_labels(v, labels, "medium"), labels, "fine")


def apply_labels(df: DataFrame, labels: DataFrame, level: str) -> DataFrame:
    """Attach ``label_<level>`` by cluster id (label maps are topic-sized)."""
    lab = labels.where(F.col("level") == level).select(
        F.col("cluster").alias(f"cluster_{level}"), F.col("label").alias(f"label_{level}"))
    return df.join(lab, f"cluster_{level}", "left")


_PAL_SQL = "SELECT * FROM (VALUES " + ", ".join(f"({i}, {S.q(c)})" for i, c in enumerate(_PAL)) + ") AS p(i, color)"


def _dom_sql(child: str, parent: str) -> str:
    return (f"SELECT {child} AS c, {parent} AS dom FROM (SELECT {child}, {parent}, row_number() OVER "
            f"(PARTITION BY {child} ORDER BY count(*) DESC, {parent}) AS r FROM t "
            f"WHERE {child} IS NOT NULL AND {parent} IS NOT NULL GROUP BY {child}, {parent}) WHERE r = 1")


@register("tree_nodes", f"""
WITH {S.topic_docs_ctes()},
t AS (SELECT stock_id AS industry, 'M' || CAST(cluster_medium AS VARCHAR) AS med,
             'F' || lpad(CAST(cluster_fine AS VARCHAR), 2, '0') AS fin FROM td),
pal AS ({_PAL_SQL}),
ind AS (SELECT industry, count(*) AS cnt, row_number() OVER (ORDER BY industry) - 1 AS i FROM t GROUP BY industry),
indc AS (SELECT ind.industry, ind.cnt, pal.color FROM ind JOIN pal ON ind.i % {len(_PAL)} = pal.i),
md AS ({_dom_sql('med', 'industry')}),
mn AS (SELECT mc.med, mc.cnt, md.dom, coalesce(indc.color, '{_FB}') AS color
       FROM (SELECT med, count(*) AS cnt FROM t GROUP BY med) mc LEFT JOIN md ON mc.med = md.c
            LEFT JOIN indc ON md.dom = indc.industry),
fd AS ({_dom_sql('fin', 'med')}),
fn AS (SELECT fc.fin, fc.cnt, fd.dom, coalesce(mn.color, '{_FB}') AS color
       FROM (SELECT fin, count(*) AS cnt FROM t GROUP BY fin) fc LEFT JOIN fd ON fc.fin = fd.c
            LEFT JOIN mn ON fd.dom = mn.med),
nodes AS (
  SELECT '{_RID}' AS id, '{_RL}' AS label, '' AS parent, 'root' AS level, (SELECT count(*) FROM t) AS cnt, '{_RC}' AS color
  UNION ALL SELECT 'ind|' || industry, industry, '{_RID}', 'industry', cnt, color FROM indc
  UNION ALL SELECT 'med|' || med, med, 'ind|' || dom, 'medium', cnt, color FROM mn
  UNION ALL SELECT 'fin|' || fin, fin, 'med|' || dom, 'fine', cnt, color FROM fn),
fv AS (SELECT id, parent, cnt AS value FROM nodes WHERE level = 'fine'),
mv AS (SELECT n.id, n.parent, greatest(n.cnt, coalesce((SELECT sum(value) FROM fv WHERE fv.parent = n.id), 0)) AS value
       FROM nodes n WHERE level = 'medium'),
iv AS (SELECT n.id, n.parent, greatest(n.cnt, coalesce((SELECT sum(value) FROM mv WHERE mv.parent = n.id), 0)) AS value
       FROM nodes n WHERE level = 'industry'),
rv AS (SELECT n.id, n.parent, greatest(n.cnt, coalesce((SELECT sum(value) FROM iv WHERE iv.parent = n.id), 0)) AS value
       FROM nodes n WHERE level = 'root'),
allv AS (SELECT * FROM fv UNION ALL SELECT * FROM mv UNION ALL SELECT * FROM iv UNION ALL SELECT * FROM rv)
SELECT n.id, n.label, n.parent, n.level, n.cnt AS count, CAST(v.value AS BIGINT) AS value, n.color,
       CAST(v.value AS DOUBLE) / p.value AS share
FROM nodes n JOIN allv v ON n.id = v.id LEFT JOIN allv p ON n.parent = p.id""")
def tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root -> industry -> medium -> fine topic tree."""
    td = topic_docs(spark, sf_dir).select(
        F.col("stock_id").alias("industry"),
        F.concat(F.lit("M"), F.col("cluster_medium").cast("string")).alias("med"),
        F.concat(F.lit("F"), F.lpad(F.col("cluster_fine").cast("string"), 2, "0")).alias("fin"))
    return rollup.tree_nodes(td, "industry", "med", "fin")


TOKEN_PATTERN = r"\p{L}{2,}"


_KEYWORDS_SQL = f"""tok AS (SELECT level, topic, doc_id, unnest(regexp_extract_all(lower(text), {S.q(TOKEN_PATTERN)})) AS term FROM tl),
tf AS (SELECT level, topic, doc_id, term, count(*) AS tf FROM tok GROUP BY level, topic, doc_id, term),
nd AS (SELECT level, topic, count(*) AS n FROM tl GROUP BY level, topic),
voc AS (SELECT level, topic, term, sum(tf) AS ttf, count(*) AS df FROM tf GROUP BY level, topic, term),
vk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY level, topic ORDER BY ttf DESC, term) AS r FROM voc)
       WHERE r <= {N_KEYWORDS}),
w AS (SELECT tf.level, tf.topic, tf.doc_id, tf.term, tf.tf * (ln((1 + nd.n) / (1 + vk.df)) + 1) AS w, nd.n
      FROM tf JOIN vk ON tf.level = vk.level AND tf.topic = vk.topic AND tf.term = vk.term
              JOIN nd ON tf.level = nd.level AND tf.topic = nd.topic),
nm AS (SELECT level, topic, doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY level, topic, doc_id),
sc AS (SELECT w.level, w.topic, w.term, sum(w.w / nm.norm) / max(w.n) AS score
       FROM w JOIN nm ON w.level = nm.level AND w.topic = nm.topic AND w.doc_id = nm.doc_id
       GROUP BY w.level, w.topic, w.term)"""


@register("topic_keywords", f"""
WITH {S.topic_docs_ctes()}, {S.both_levels_cte()},
{_KEYWORDS_SQL}
SELECT level, topic,
       CAST(row_number() OVER (PARTITION BY level, topic ORDER BY round(score, 9) DESC, term) AS INTEGER) AS rank,
       term, round(score, 6) AS score FROM sc""")
def topic_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top TF-IDF terms per topic (vocabulary capped at 15 by count)."""
    return _keywords(topic_docs(spark, sf_dir)).withColumn("score", F.round("score", 6))


def _keywords(td: DataFrame) -> DataFrame:
    return keywords.topic_keywords(segment.segmented_tokens(td, "text", pattern=TOKEN_PATTERN), {"medium": "cluster_medium", "fine": "cluster_fine"},
                                   "doc_id", "tokens")


@register("topic_brief", f"""
WITH {S.topic_docs_ctes()}, {S.both_levels_cte()},
sz AS (SELECT level, topic, count(*) AS size FROM tl GROUP BY level, topic),
ic AS (SELECT level, topic, lang, count(*) AS n FROM tl GROUP BY level, topic, lang),
ir AS (SELECT *, row_number() OVER (PARTITION BY level, topic ORDER BY n DESC, lang) AS r FROM ic),
ind AS (SELECT level, topic, string_agg(lang || '(' || CAST(n AS VARCHAR) || ')', ', ' ORDER BY r) AS top_industries
        FROM ir WHERE r <= {N_TOP_INDUSTRIES} GROUP BY level, topic),
sr AS (SELECT level, topic, replace(substring(text, 1, {SAMPLE_CHARS}), chr(10), ' ') AS s,
              row_number() OVER (PARTITION BY level, topic ORDER BY length(text), doc_id) AS r FROM tl),
smp AS (SELECT level, topic, string_agg(s, ' | ' ORDER BY r) AS samples FROM sr WHERE r <= {N_SAMPLES}
        GROUP BY level, topic),
{_KEYWORDS_SQL},
kl AS (SELECT level, topic, string_agg(term, ', ' ORDER BY round(score, 9) DESC, term) AS keywords FROM sc GROUP BY level, topic)
SELECT sz.level, sz.topic, sz.size, ind.top_industries, kl.keywords, smp.samples
FROM sz LEFT JOIN ind ON sz.level = ind.level AND sz.topic = ind.topic
        LEFT JOIN smp ON sz.level = smp.level AND sz.topic = smp.topic
        LEFT JOIN kl ON sz.level = kl.level AND sz.topic = kl.topic""")
def topic_brief(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per topic its size, top-3 industries, keywords and 3 shortest samples."""
    td = topic_docs(spark, sf_dir)
    b = rollup.topic_brief(both_levels(td), ["level", "topic"], "lang", "text", "doc_id", _keywords(td))
    return b.select("level", "topic", "size", F.array_join("top_industries", ", ").alias("top_industries"),
                    F.array_join("keywords", ", ").alias("keywords"), F.array_join("samples", " | ").alias("samples"))


_RUNS_SQL = f"""
runs AS (SELECT run, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), {S.q(TOKEN_PATTERN)})) AS run FROM documents) GROUP BY run),
g AS (SELECT substr(run, i, m) AS gram, CASE WHEN i > 1 THEN substr(run, i - 1, 1) ELSE '' END AS l, substr(run, i + m, 1) AS r, n
      FROM (SELECT run, n, unnest(range(1, length(run) + 1)) AS i FROM runs), (SELECT unnest(range(1, {segment.MAX_CHARS + 1})) AS m)
      WHERE i + m - 1 <= length(run)),
c AS (SELECT gram, sum(n) AS n FROM g GROUP BY gram HAVING sum(n) >= {segment.MIN_COUNT} OR length(gram) = 1),
t AS (SELECT sum(n) AS chars FROM c WHERE length(gram) = 1),
le AS (SELECT gram, ln(sum(x)) - sum(x * ln(x)) / sum(x) AS h FROM (SELECT gram, l, sum(n) AS x FROM g GROUP BY gram, l) GROUP BY gram),
re AS (SELECT gram, ln(sum(x)) - sum(x * ln(x)) / sum(x) AS h FROM (SELECT gram, r, sum(n) AS x FROM g GROUP BY gram, r) GROUP BY gram),
p AS (SELECT gram, n, unnest(range(1, length(gram))) AS i FROM c WHERE length(gram) > 1),
co AS (SELECT p.gram, min(ln(p.n * t.chars / (CAST(a.n AS DOUBLE) * b.n))) AS cohesion
       FROM p, t, c a, c b WHERE a.gram = substr(p.gram, 1, p.i) AND b.gram = substr(p.gram, p.i + 1) GROUP BY p.gram),
score AS (SELECT c.gram, CAST(c.n AS BIGINT) AS n, co.cohesion, le.h AS left_entropy, re.h AS right_entropy
          FROM c LEFT JOIN co ON co.gram = c.gram JOIN le ON le.gram = c.gram JOIN re ON re.gram = c.gram)"""


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read_table(spark, sf_dir, "documents", "text"))
    return staged(segment.letter_runs(docs, "text", TOKEN_PATTERN), "letter-runs")


@register("word_lexicon", f"""
WITH {_RUNS_SQL}
SELECT gram, n, round(cohesion, 6) AS cohesion, round(left_entropy, 6) AS left_entropy, round(right_entropy, 6) AS right_entropy FROM score""")
def word_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: count, cohesion and branching entropies of the n-grams of all letter runs."""
    scores = segment.lexicon_scores(_runs(spark, sf_dir))
    return scores.select("gram", "n", *[F.round(c, 6).alias(c) for c in ("cohesion", "left_entropy", "right_entropy")])


@register("segmented_words", f"""
WITH RECURSIVE {_RUNS_SQL},
lex AS (SELECT gram, ln(n / (SELECT chars FROM t)) AS w FROM score
        WHERE length(gram) = 1 OR (cohesion >= {segment.MIN_COHESION} AND least(left_entropy, right_entropy) >= {segment.MIN_ENTROPY})),
path AS (SELECT run, 0 AS j, [0.0::DOUBLE] AS best, [0::BIGINT] AS back FROM runs
         UNION ALL
         SELECT run, j + 1, list_append(any_value(best), last(score ORDER BY round(score, 9), m)), list_append(any_value(back), last(m ORDER BY round(score, 9), m))
         FROM (SELECT path.*, m, best[j + 2 - m] + lex.w AS score FROM path, (SELECT unnest(range(1, {segment.MAX_CHARS + 1})) AS m), lex
               WHERE j < length(run) AND m <= j + 1 AND lex.gram = substr(run, j + 2 - m, m))
         GROUP BY run, j),
walk AS (SELECT run, back, j, CAST([] AS VARCHAR[]) AS words FROM path WHERE j = length(run)
         UNION ALL
         SELECT run, back, j - back[j + 1], list_prepend(substr(run, CAST(j - back[j + 1] + 1 AS BIGINT), back[j + 1]), words) FROM walk WHERE j > 0)
SELECT walk.run, runs.n, array_to_string(words, '|') AS words FROM walk JOIN runs ON runs.run = walk.run WHERE j = 0""")
def segmented_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: every letter run cut into words along the best path of the learned lexicon."""
    runs = _runs(spark, sf_dir)
    cut = segment.segment_runs(runs, segment.learn(segment.lexicon_scores(runs)))
    return cut.select("run", "n", F.array_join("words", "|").alias("words"))


# ================================================================ pages (H1-H5)
from ..operators import pages as pg  # noqa: E402

HREF_PATTERN = 'href="([^"]+)"'
_MATCHES_SQL = f"""
m AS (SELECT page_id, url, unnest(regexp_extract_all(html, {S.q(HREF_PATTERN)}, 1)) AS match,
             generate_subscripts(regexp_extract_all(html, {S.q(HREF_PATTERN)}, 1), 1) - 1 AS pos FROM pages)"""


def _unescape_sql(x: str) -> str:
    """The character references that occur in the landed pages, decoded (``&amp;`` last)."""
    for ent, ch in [("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"),
                    ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")]:
        x = f"replace({x}, {S.q(ent)}, {S.q(ch)})"
    return x


# In the landed pages the <article> holds only h1, p, b and br, so the text nodes are the
# runs between tags; the extractor joins them with newlines, which SQL states as "every
# run of tags becomes one newline".
_ARTICLE_TEXT = _unescape_sql(
    "regexp_replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '(<[^>]*>)+', chr(10), 'g')")
_SIG_SQL = S.q(rf"(?s)\n--[{S.WS}]*\n.*$")


@register("page_text", f"""
SELECT page_id,
       {S.strip_sql(f"regexp_replace(regexp_replace({_ARTICLE_TEXT}, {_SIG_SQL}, ''), '\n{{3,}}', chr(10) || chr(10), 'g')")} AS text
FROM pages""")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main article text of each landed page (container minus navigation/ads)."""
    p = spread(read_table(spark, sf_dir, "pages", "page_id", "html"))
    return pg.extract_main(p, container="article", drop=["nav", "footer", "div.ad", "script", "style"])


# In the landed pages every list item is exactly one link (<li><a href="..">text</a></li>)
# and none has a date, so a regex states the expected rows.
_LI = r'<li><a href="([^"]*)">([^<]*)</a></li>'


@register("page_links", f"""
WITH m AS (
  SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) AS origin,
         unnest(regexp_extract_all(html, {S.q(_LI)}, 1)) AS href,
         unnest(regexp_extract_all(html, {S.q(_LI)}, 2)) AS raw_title,
         generate_subscripts(regexp_extract_all(html, {S.q(_LI)}, 1), 1) - 1 AS pos
  FROM pages)
SELECT page_id, CAST(pos AS INTEGER) AS pos, {S.strip_sql(_unescape_sql("raw_title"))} AS title,
       origin || {_unescape_sql("href")} AS url, '' AS date
FROM m""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: listing rows with a link -> (title, absolute url, date)."""
    p = spread(read_table(spark, sf_dir, "pages", "page_id", "url", "html")).withColumn(
        "origin", F.regexp_extract("url", r"^(https?://[^/]+)", 1))
    return pg.extract_links(p, row="li", link="a", date="span.date", base_col="origin")


@register("page_links_regex", f"""
WITH {_MATCHES_SQL}
SELECT page_id, CAST(pos AS INTEGER) AS pos, match FROM m""")
def page_links_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: every href in every page, with its position (regex rule, SQL only)."""
    p = spread(read_table(spark, sf_dir, "pages", "page_id", "html"))
    return pg.extract_matches(p, "html", HREF_PATTERN)


@register("link_index", f"""
WITH {_MATCHES_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY match ORDER BY page_id DESC, pos DESC) AS rn FROM m)
SELECT match AS href, page_id, url FROM r WHERE rn = 1""")
def link_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3 + W3: link target -> the page that mentions it last (later hits replace earlier)."""
    p = spread(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))
    m = pg.extract_matches(p, "html", HREF_PATTERN, keep=("page_id", "url"))
    return dedupe.last_wins(m, ["match"], ["page_id", "pos"]).select(
        F.col("match").alias("href"), "page_id", "url")


# ================================================================ clustering
import pandas as pd  # noqa: E402

from ..functions.fixed import (AUTO_RANGES, FINE_MIN_GAP, LAST_MERGES, LEVELS, N_NEIGHBORS,  # noqa: E402
                               REDUCED_DIMS)
from ..operators import cluster, hierarchy, layout, neighbours, semantic  # noqa: E402

#: Share of the exact edges that the descent has to find.
RECALL = 0.9


@register("embed_docs")
def embed_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit-length document vectors (hashed terms + CJK bigrams, L2-normalised),
    through a cache keyed by (model, sha256(text)): the session's, else a new shared folder."""
    d = spread(kept_docs(spark, sf_dir).select("doc_id", "text"))
    cache = cluster.cache_folder(spark)
    return cluster.embed_cached(spark, d, cache, "clean-v1/hashed-1024",
                                prepare=lambda c: clean_text(strip(c))).select("doc_id", "embedding")


def _semantic(spark: SparkSession, sf_dir: str):
    docs = spread(read_table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", tokenize("text", TOKEN_PATTERN).alias("tokens"))
    counts = semantic.counted(docs, "doc_id", "tokens")
    return semantic.flat(counts), semantic.learn(counts)


@register("semantic_docs")
def semantic_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: unit-length document vectors learned from the corpus (sparse PPMI rows, randomized range finder)."""
    return semantic.doc_vectors(_semantic(spark, sf_dir)[1]).withColumnRenamed("doc", "doc_id")


@register("semantic_space", f"""
WITH tok AS (SELECT doc_id AS doc, unnest(regexp_extract_all(lower(text), {S.q(TOKEN_PATTERN)})) AS term FROM documents),
tf AS (SELECT doc, term, count(*) AS c FROM tok GROUP BY doc, term),
kt AS (SELECT term, sum(c) AS ct FROM tf GROUP BY term HAVING count(*) >= {semantic.MIN_DOCS}),
k AS (SELECT doc, term, c, ct, sum(c) OVER (PARTITION BY doc) AS cd, sum(c) OVER () AS n FROM tf JOIN kt USING (term)),
a AS (SELECT doc, ln(c * CAST(n AS DOUBLE) / (CAST(cd AS DOUBLE) * ct)) AS a FROM k)
SELECT count(DISTINCT doc) AS documents, count(*) AS entries, round(sum(a * a), 1) AS energy, {semantic.DIMS} AS rank,
       TRUE AS unit_rows, TRUE AS values_fall FROM a WHERE a > 0""")
def semantic_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: entries and squares of the sparse rows, rank of the learned axes, length of the vectors."""
    rows, space = _semantic(spark, sf_dir)
    length = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    unit = semantic.doc_vectors(space).agg((F.max(F.abs(length - 1)) < 1e-9).alias("unit_rows"))
    v = space.values
    falls = bool((v[:-1] >= v[1:]).all() and 0 < space.captured < space.energy)
    return rows.agg(F.count_distinct("doc").alias("documents"), F.count(F.lit(1)).alias("entries"), F.round(F.sum(F.col("a") * F.col("a")), 1).alias("energy")).select(
        "*", F.lit(int((v > 1e-6 * v[0]).sum())).alias("rank")).join(unit).withColumn("values_fall", F.lit(falls))  # one row each


@register("pca_2d")
def pca_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: 15-d reduction, then 2-d coordinates (x, y) for the map of documents."""
    from pyspark.ml.functions import vector_to_array
    v = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    r15 = cluster.reduce(v, "embedding", REDUCED_DIMS, "r15")
    r2 = cluster.reduce(r15.select("vec_id", "r15"), "r15", 2, "r2")
    xy = vector_to_array("r2")
    return r2.select("vec_id", xy[0].alias("x"), xy[1].alias("y"))


@register("pca_variance", """
WITH e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS d FROM embeddings),
v AS (SELECT d, var_samp(x) AS s FROM e GROUP BY d)
SELECT (SELECT count(*) FROM embeddings) AS n, round(sum(s), 4) AS total_variance, CAST(0 AS DOUBLE) AS cov_xy FROM v""")
def pca_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: a reduction to as many axes as there are keeps the total variance, and its first
    two axes are uncorrelated (the coordinates themselves have arbitrary signs)."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer
    v = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    dims = v.agg(F.max(F.size("embedding"))).first()[0]
    r = cluster.reduce(v, "embedding", dims, "r")
    xy = vector_to_array("r")
    per_axis = vector_to_array(Summarizer.variance(F.col("r")))
    return r.agg(F.count(F.lit(1)).alias("n"),
                 F.round(F.aggregate(per_axis, F.lit(0.0), lambda a, x: a + x), 4).alias("total_variance"),
                 F.round(F.abs(F.covar_samp(xy[0], xy[1])), 6).alias("cov_xy"))


@register("knn_graph", f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
p AS (SELECT a.vec_id, b.vec_id AS neighbor_id, list_cosine_similarity(a.e, b.e) AS sim
      FROM v a JOIN v b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(sim, 9) DESC, neighbor_id) AS rank FROM p)
SELECT vec_id, CAST(rank AS INTEGER) AS rank, neighbor_id, round(sim, 6) AS sim FROM r WHERE rank <= {N_NEIGHBORS}""")
def knn_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: exact 30-nearest-neighbour cosine graph over all vectors."""
    v = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    g = cluster.knn_graph(v, "vec_id", "embedding", N_NEIGHBORS)
    return g.withColumn("sim", F.round("sim", 6))


@register("knn_descent")
def knn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: the 30-nearest-neighbour graph by neighbour descent, whose cost does not grow with n^2."""
    v = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return neighbours.knn_descent(v, "vec_id", "embedding", N_NEIGHBORS).withColumn("sim", F.round("sim", 6))


@register("knn_recall", f"""
SELECT count(*) AS documents, count(*) * {N_NEIGHBORS} AS edges, TRUE AS recall_reached FROM embeddings""")
def knn_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: whether the descent finds RECALL of all edges of the exact graph, over all rows."""
    v = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    found = staged(knn_descent(spark, sf_dir).select("vec_id", "neighbor_id"), "descent")
    exact = cluster.knn_graph(v, "vec_id", "embedding", N_NEIGHBORS).select("vec_id", "neighbor_id", F.lit(1).alias("hit"))
    both = found.join(exact, ["vec_id", "neighbor_id"], "left")
    return both.agg(F.count_distinct("vec_id").alias("documents"), F.count(F.lit(1)).alias("edges"),
                    (F.count("hit") >= RECALL * F.count(F.lit(1))).alias("recall_reached"))


@register("fuzzy_edges", f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
p AS (SELECT a.vec_id, b.vec_id AS neighbor_id, list_cosine_similarity(a.e, b.e) AS sim
      FROM v a JOIN v b ON a.vec_id <> b.vec_id),
k AS (SELECT vec_id, neighbor_id, greatest(0.0, 1 - sim) AS d FROM p
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(sim, 9) DESC, neighbor_id) <= {N_NEIGHBORS}),
r AS (SELECT vec_id, coalesce(min(d) FILTER (d > 0), 0.0) AS rho, list(d) AS ds FROM k GROUP BY vec_id),
s AS (SELECT vec_id, rho, ds, 0 AS step, 0.0::DOUBLE AS low, 'inf'::DOUBLE AS high, 1.0::DOUBLE AS mid FROM r
      UNION ALL
      SELECT vec_id, rho, ds, step + 1, CASE WHEN t > log2({N_NEIGHBORS}) THEN low ELSE mid END, CASE WHEN t > log2({N_NEIGHBORS}) THEN mid ELSE high END,
             CASE WHEN t > log2({N_NEIGHBORS}) THEN (low + mid) / 2 WHEN high = 'inf'::DOUBLE THEN mid * 2 ELSE (mid + high) / 2 END
      FROM (SELECT *, list_sum(list_transform(ds, lambda x: exp(-greatest(0.0, x - rho) / mid))) AS t FROM s WHERE step < {layout.HALVINGS})),
m AS (SELECT k.vec_id, neighbor_id, exp(-greatest(0.0, d - rho) / mid) AS w FROM k JOIN s ON s.vec_id = k.vec_id AND s.step = {layout.HALVINGS})
SELECT least(vec_id, neighbor_id) AS a, greatest(vec_id, neighbor_id) AS b,
       round(sum(w) - CASE WHEN count(*) > 1 THEN max(w) * min(w) ELSE 0 END, 6) AS w
FROM m GROUP BY 1, 2""")
def fuzzy_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: undirected weights of the neighbour graph, each row with its own bandwidth."""
    v = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    graph = cluster.knn_graph(v, "vec_id", "embedding", N_NEIGHBORS)
    return layout.fuzzy_union(layout.memberships(graph, "vec_id", N_NEIGHBORS), "vec_id").withColumn("w", F.round("w", 6))


def _layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    graph = neighbours.knn_descent(v, "vec_id", "embedding", N_NEIGHBORS)
    edges = staged(layout.fuzzy_union(layout.memberships(graph, "vec_id", N_NEIGHBORS), "vec_id"), "fuzzy-edges")
    return layout.spectral_layout(edges, "vec_id", REDUCED_DIMS)[0]


@register("spectral_layout")
def spectral_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5, M4: 15-d reduction that keeps neighbours: descent graph, fuzzy weights, spectral layout."""
    return _layout(spark, sf_dir)


@register("layout_quality", f"""
SELECT count(*) AS documents, {REDUCED_DIMS} AS dims, TRUE AS unit_rows, TRUE AS better_than_pca FROM embeddings""")
def layout_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: whether the layout keeps a larger share of the exact 30 neighbours than PCA to as many axes."""
    from pyspark.ml.functions import vector_to_array
    v = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    made = staged(_layout(spark, sf_dir), "layout")
    pca = cluster.reduce(v, "embedding", REDUCED_DIMS, "r").select("vec_id", vector_to_array("r").alias("r"))
    exact = staged(cluster.knn_graph(v, "vec_id", "embedding", N_NEIGHBORS).select("vec_id", "neighbor_id"), "exact-graph")
    share = [layout.kept_neighbours(exact, cluster.knn_graph(x, "vec_id", c, N_NEIGHBORS), "vec_id", N_NEIGHBORS) for x, c in ((made, "layout"), (pca, "r"))]
    length = F.aggregate("layout", F.lit(0.0), lambda a, x: a + x * x)
    return made.agg(F.count(F.lit(1)).alias("documents"), F.max(F.size("layout")).alias("dims"),
                    (F.max(F.abs(length - 1)) < 1e-9).alias("unit_rows")).withColumn("better_than_pca", F.lit(share[0] > share[1]))


@register("ward_topics", f"""
WITH {S.ward_ctes()},
cuts(level, kk) AS (VALUES {", ".join(f"({S.q(x)}, {k})" for x, k in LEVELS.items())}),
done AS (SELECT level, m.low, m.high FROM cuts JOIN merges m
         ON m.height <= (SELECT max(x.height) FROM merges x WHERE x.step < (SELECT any_value(k) FROM leaf) - cuts.kk)),
up AS (SELECT level, id, id AS tip FROM cuts, leaf
       UNION ALL SELECT up.level, up.id, done.low FROM up JOIN done ON done.level = up.level AND done.high = up.tip),
tops AS (SELECT level, id, dense_rank() OVER (PARTITION BY level ORDER BY tip) AS topic FROM (SELECT level, id, min(tip) AS tip FROM up GROUP BY level, id)),
member AS (SELECT vec_id, min(vec_id) OVER (PARTITION BY embedding) AS id FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL)
SELECT vec_id, {", ".join(f"CAST(max(topic) FILTER (level = {S.q(x)}) AS INTEGER) AS cluster_{x}" for x in LEVELS)}
FROM member JOIN tops USING (id) GROUP BY vec_id""")
def ward_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6, M7: exact Ward hierarchy over all vectors, cut into 25 medium and 60 fine topics."""
    v = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return hierarchy.ward_topics(spark, v, "vec_id", "embedding", LEVELS)[0]


@register("merge_table", f"""
WITH {S.ward_ctes()},
sides AS (SELECT m.step, m.height, m.size, coalesce(lag(m.step) OVER (PARTITION BY m.low ORDER BY m.step) + l.k, l.node) AS a,
                 coalesce((SELECT max(x.step) FROM merges x WHERE x.low = m.high) + r.k, r.node) AS b
          FROM merges m JOIN leaf l ON l.id = m.low JOIN leaf r ON r.id = m.high)
SELECT step, least(a, b) AS "left", greatest(a, b) AS "right", round(height, 6) AS height, size
FROM sides ORDER BY step DESC LIMIT {LAST_MERGES}""")
def merge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 60 merges of the Ward hierarchy (step, left, right, height, size)."""
    v = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    _, merges = hierarchy.ward_topics(spark, v, "vec_id", "embedding", LEVELS)
    return cluster.last_merges(merges, LAST_MERGES).withColumn("height", F.round("height", 6))


@register("ward_levels", """
SELECT level, count(vec_id) AS documents, CAST(0 AS BIGINT) AS split_topics
FROM embeddings, (SELECT unnest(['medium', 'fine']) AS level) GROUP BY level""")
def ward_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6, M7: per level the documents with a topic, and the topics of the level that are
    split over several topics of the level above (none, as the cuts nest)."""
    topics = ward_topics(spark, sf_dir)
    n = topics.groupBy("cluster_medium", "cluster_fine").agg(F.count("vec_id").alias("n"))
    n = n.select("n", F.explode(F.array(
        F.struct(F.lit("medium").alias("level"), F.col("cluster_medium").alias("topic"), F.lit(0).alias("above")),
        F.struct(F.lit("fine").alias("level"), F.col("cluster_fine").alias("topic"), F.col("cluster_medium").alias("above")))).alias("t"))
    per = n.groupBy("t.level", "t.topic").agg(F.sum("n").alias("n"), F.count_distinct("t.above").alias("above"))
    return per.groupBy("level").agg(F.sum("n").alias("documents"), F.count(F.when(F.col("above") > 1, 1)).alias("split_topics"))


@register("merge_energy", """
WITH e AS (SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings),
c AS (SELECT d, sum(x * x) - sum(x) * sum(x) / count(*) AS ss FROM e GROUP BY d)
SELECT (SELECT count(*) FROM embeddings) AS n, round(sum(ss), 4) AS total_ss FROM c""")
def merge_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every Ward merge adds half its squared height to the scatter inside
    clusters; with the scatter inside the leaves all merges add up to the total."""
    v = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    _, leaves = hierarchy.leaf_features(v, "vec_id", "embedding")
    _, merges = hierarchy.ward_tree(leaves)
    s2 = F.aggregate("s", F.lit(0.0), lambda a, x: a + x * x)
    inner = leaves.agg(F.sum("n").alias("n"), F.sum(F.col("ss") - s2 / F.col("n")).alias("inner"))
    return inner.select("n", F.round(F.col("inner") + float((merges["height"] ** 2).sum() / 2), 4).alias("total_ss"))


@register("best_k", f"""
WITH {S.ward_ctes()},
x AS (SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings),
total AS (SELECT sum(ss) AS t, any_value(n) AS n FROM (SELECT d, sum(x * x) - sum(x) * sum(x) / count(*) AS ss, count(*) AS n FROM x GROUP BY d)),
within_k AS (SELECT k - step - 1 AS k, sum(height * height / 2) OVER (ORDER BY step) AS w FROM merges CROSS JOIN (SELECT any_value(k) AS k FROM leaf)),
score AS (SELECT CAST(k AS INTEGER) AS k, ((t - w) / (k - 1)) / (w / (n - k)) AS ch FROM within_k, total WHERE k > 1),
med AS (SELECT * FROM score WHERE k >= {AUTO_RANGES["medium"][0]} AND k < {AUTO_RANGES["medium"][1]}),
medk AS (SELECT first(k ORDER BY ch DESC, k) AS k FROM med),
fin AS (SELECT * FROM score WHERE k >= greatest({AUTO_RANGES["fine"][0]}, (SELECT k FROM medk) + {FINE_MIN_GAP}) AND k < {AUTO_RANGES["fine"][1]}),
fink AS (SELECT first(k ORDER BY ch DESC, k) AS k FROM fin)
SELECT 'medium' AS level, k, round(ch, 6) AS ch, k = (SELECT k FROM medk) AS chosen FROM med
UNION ALL SELECT 'fine', k, round(ch, 6), k = (SELECT k FROM fink) FROM fin""")
def best_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: Calinski-Harabasz for every candidate k of each level, from the leaves' features."""
    v = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    leaves = hierarchy.leaf_features(v, "vec_id", "embedding")[1]
    _, merges = hierarchy.ward_tree(leaves)
    lo, hi = AUTO_RANGES["medium"]
    med = hierarchy.k_scores(leaves, merges, range(lo, hi))
    kmed = cluster.chosen_k(med)
    flo, fhi = AUTO_RANGES["fine"]
    fin = hierarchy.k_scores(leaves, merges, range(max(flo, kmed + FINE_MIN_GAP), fhi))
    kfin = cluster.chosen_k(fin)
    both = pd.concat([med.assign(level="medium", chosen=med["k"] == kmed), fin.assign(level="fine", chosen=fin["k"] == kfin)])
    return spark.createDataFrame(both[["level", "k", "ch", "chosen"]], "level string, k int, ch double, chosen boolean").withColumn("ch", F.round("ch", 6))


@register("ch_score", """
WITH v AS (SELECT vec_id, label AS fine, CAST(floor(label / 3) AS INTEGER) AS medium, embedding FROM embeddings),
l AS (SELECT 'medium' AS level, medium AS cluster, vec_id, embedding FROM v
      UNION ALL SELECT 'fine', fine, vec_id, embedding FROM v),
e AS (SELECT level, cluster, vec_id, CAST(unnest(embedding) AS DOUBLE) AS x,
             generate_subscripts(embedding, 1) AS d FROM l),
cd AS (SELECT level, cluster, d, sum(x) AS s FROM e GROUP BY level, cluster, d),
cn AS (SELECT level, cluster, count(DISTINCT vec_id) AS n, sum(x * x) AS ss FROM e GROUP BY level, cluster),
c2 AS (SELECT cd.level, cd.cluster, sum(s * s) / max(cn.n) AS s2n FROM cd
       JOIN cn ON cd.level = cn.level AND cd.cluster = cn.cluster GROUP BY cd.level, cd.cluster),
td AS (SELECT level, d, sum(x) AS s FROM e GROUP BY level, d),
t2 AS (SELECT level, sum(s * s) AS S2 FROM td GROUP BY level),
g AS (SELECT c2.level, count(*) AS k, sum(c2.s2n) AS s2n FROM c2 GROUP BY c2.level),
gn AS (SELECT level, sum(n) AS n, sum(ss) AS ss FROM cn GROUP BY level)
SELECT g.level, g.k, CAST(gn.n AS BIGINT) AS n,
       round(((g.s2n - t2.S2 / gn.n) / (g.k - 1)) / ((gn.ss - g.s2n) / (gn.n - g.k)), 6) AS ch
FROM g JOIN gn ON g.level = gn.level JOIN t2 ON g.level = t2.level""")
def ch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10, M8: Calinski-Harabasz of the medium and fine groupings."""
    v = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label").select(
        "embedding", F.col("label").alias("cluster_fine"),
        F.floor(F.col("label") / 3).cast("int").alias("cluster_medium"))
    levels = both_levels(v).select("level", F.col("topic").alias("cluster"), "embedding")
    return cluster.ch_score(levels, "embedding", ["level", "cluster"]).withColumn("ch", F.round("ch", 6))


@register("assign_topics", """
WITH e AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS d
           FROM embeddings),
c AS (SELECT label, d, avg(x) AS m FROM e GROUP BY label, d),
dist AS (SELECT e.vec_id, c.label, sum((e.x - c.m) * (e.x - c.m)) AS dd FROM e JOIN c ON e.d = c.d
         GROUP BY e.vec_id, c.label),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(dd, 9), label) AS rn FROM dist)
SELECT vec_id, label AS topic FROM r WHERE rn = 1""")
def assign_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: assign every vector to its nearest topic centroid (centroids from the topics)."""
    v = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    cents = cluster.centroids(v, "embedding", "label").toPandas()  # one row per topic
    return cluster.assign_topics(v, "vec_id", "embedding", cents.rename(columns={"label": "topic"}))


# ================================================================ incremental ingest
from ..streaming import ingest  # noqa: E402

#: Rows of a landed file, least bytes of a micro-batch, and micro-batches at most (about).
INGEST_ROWS, INGEST_BYTES, INGEST_BATCHES = 1000, 4 << 20, 8


@register("resume_ingest", """
SELECT url, stock_id, doc_id, title, text, created_at FROM (
  SELECT sha256(text) AS url, source AS stock_id, doc_id, substring(text, 1, 40) AS title, text,
         strftime(try_strptime('2023/' || CAST(doc_id % 12 + 1 AS VARCHAR) || '/' || CAST(doc_id % 31 + 1 AS VARCHAR), '%Y/%m/%d'),
                  '%Y-%m-%d') AS created_at,
         row_number() OVER (PARTITION BY sha256(text) ORDER BY source, doc_id) AS rn FROM documents)
WHERE rn = 1""")
def resume_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles (title, text, post time) land as files; a streaming job ingests
    them batch by batch into a claim log (URL -> first finder), then runs again and adds
    nothing.  The result equals the batch URL claim over the whole table."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    posted = F.concat_ws("/", F.col("doc_id") % 12 + 1, F.col("doc_id") % 31 + 1)
    d = d.select(F.sha2(F.col("text"), 256).alias("url"), F.col("source").alias("stock_id"), "doc_id",
                 F.substring("text", 1, 40).alias("title"), "text", posted.alias("post_text"))
    root = scratch_path(spark, "ingest")
    src = ingest.land_files(d, f"{root}/landed", INGEST_ROWS)
    sink, ckpt = f"{root}/articles", f"{root}/checkpoint"
    size = ingest.share_of_files(spark, src, d.schema, INGEST_BATCHES, INGEST_BYTES)
    ingest.resume_ingest(spark, src, d.schema, sink, ckpt, batch_bytes=size)
    if ingest.resume_ingest(spark, src, d.schema, sink, ckpt, batch_bytes=size):
        raise RuntimeError("second ingest run over the same files found new input")
    created = F.date_format(post_date_fn("post_text", POST_YEAR), "yyyy-MM-dd")
    return ingest.claimed(spark, sink).select("url", "stock_id", "doc_id", "title", "text", created.alias("created_at"))


# ================================================================ the whole topic workflow
from . import topics as topic_run  # noqa: E402


@register("topic_assignments")
def topic_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic workflow end to end.

    Documents play articles (stock = source); the stock dimension is derived from the
    same table (each source's dominant language as its industry).  Cluster ids are
    arbitrary, so this key is checked by row count; its parts have oracles of their own.
    """
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    stocks = rollup.dominant(d, "source", "lang", "industry_name").withColumnRenamed("source", "stock_code")
    posted = post_date_fn(F.concat_ws("/", F.col("doc_id") % 12 + 1, F.col("doc_id") % 31 + 1), POST_YEAR)
    arts = spread(d.select("doc_id", F.col("source").alias("stock_id"), "text", posted.alias("created_at")))
    docs = topic_run.cluster_phase(spark, arts, stocks, scratch_path(spark, "topics"))
    return topic_run.result(topic_run.with_labels(docs, None))


# ================================================================ chain pages, metrics, heat
from . import chains, heat, listings, stored  # noqa: E402, F401
