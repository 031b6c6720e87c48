"""Load metrics, the done set and the heat queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.market import pct_value
from ..operators import dedupe, heat, market
from ..sources.tables import read_table
from . import catalog as C

MAX_LAG = 3


@C.register("load_metrics", """
WITH q AS (SELECT DISTINCT user_id FROM events)
SELECT 'rows' AS metric, count(*) AS value FROM customer
UNION ALL SELECT 'rows_updated', count(*) FROM customer WHERE c_custkey IN (SELECT user_id FROM q)
UNION ALL SELECT 'rows_fetched', count(*) FROM events
UNION ALL SELECT 'chains_seen', count(DISTINCT p_brand) FROM part""")
def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes fetched, rows of the stock list, rows updated by them, chains seen."""
    chains = read_table(spark, sf_dir, "part", "p_brand").withColumnRenamed("p_brand", "chain_ic")
    return market.load_metrics(C.quote_update(spark, sf_dir), read_table(spark, sf_dir, "events", "event_id"), chains)


@C.register("done_set", "SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def done_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested work that is done."""
    return dedupe.done_requested(read_table(spark, sf_dir, "documents", "doc_id"), read_table(spark, sf_dir, "labels", "doc_id"), "doc_id")


def _quoted(e: DataFrame) -> DataFrame:
    """Events as quotes: close, change in % and volume."""
    return e.select(F.col("user_id").alias("stock_code"), "ts", "event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"),
                    pct_value(F.col("value"), F.col("value") / 10 - 1).alias("change_pct"), (F.col("event_id") * 100).alias("volume"))


_QUOTED = """
e AS (SELECT user_id AS stock_code, ts, event_id, strftime(ts, '%Y-%m-%d') AS day, event_id * 100 AS volume,
             CASE WHEN value - (value / 10 - 1) <> 0 THEN (value / 10 - 1) / (value - (value / 10 - 1)) * 100 END AS change_pct FROM events),
q AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY ts DESC, event_id DESC) AS rn FROM e) WHERE rn = 1)"""


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _quoted(read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "value"))
    return dedupe.last_wins(e, ["stock_code"], ["ts", "event_id"])


@C.register("topic_heat", f"""
WITH {_QUOTED},
m AS (SELECT o_orderpriority AS topic, o_custkey AS stock_code, count(*) AS n FROM orders GROUP BY ALL)
SELECT topic, CAST(sum(n) AS BIGINT) AS mentions, CAST(sum(volume) AS BIGINT) AS volume,
       round(sum(volume * change_pct) / sum(volume) FILTER (change_pct IS NOT NULL), 4) AS weighted_change
FROM m LEFT JOIN q USING (stock_code) GROUP BY topic""")
def topic_heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders play articles (topic = priority, stock = customer), events the quotes."""
    m = read_table(spark, sf_dir, "orders", "o_orderpriority", "o_custkey").toDF("topic", "stock_code")
    return heat.topic_heat(m, _latest(spark, sf_dir)).withColumn("weighted_change", F.round("weighted_change", 4))


@C.register("chain_heat", f"""
WITH {_QUOTED},
c AS (SELECT DISTINCT p_brand AS chain_ic, p_type AS segment, l_suppkey AS stock_code FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT chain_ic, segment, count(*) AS stocks, CAST(sum(volume) AS BIGINT) AS volume,
       round(avg(change_pct), 4) AS mean_change, round(avg(CAST(change_pct > 0 AS INTEGER)), 4) AS advancing
FROM c LEFT JOIN q USING (stock_code) GROUP BY chain_ic, segment""")
def chain_heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chain = brand, segment = part type, stock = supplier of a line item."""
    li = read_table(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey").distinct()
    pt = read_table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type")
    c = li.join(pt, li["l_partkey"] == pt["p_partkey"]).select(
        F.col("p_brand").alias("chain_ic"), F.col("p_type").alias("segment"), F.col("l_suppkey").alias("stock_code"))
    h = heat.chain_heat(c, _latest(spark, sf_dir))
    return h.withColumn("mean_change", F.round("mean_change", 4)).withColumn("advancing", F.round("advancing", 4))


@C.register("event_corr", f"""
WITH {_QUOTED},
d AS (SELECT stock_code, day, count(*) AS mentions, arg_max(change_pct, (ts, event_id)) AS y FROM e GROUP BY stock_code, day),
l AS (SELECT stock_code, lag, y, CASE lag WHEN 0 THEN mentions WHEN 1 THEN x1 WHEN 2 THEN x2 ELSE x3 END AS x
      FROM (SELECT *, lag(mentions, 1) OVER w AS x1, lag(mentions, 2) OVER w AS x2, lag(mentions, 3) OVER w AS x3
            FROM d WINDOW w AS (PARTITION BY stock_code ORDER BY day)), (SELECT unnest([0, 1, 2, 3]) AS lag)),
p AS (SELECT stock_code, lag, CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN x END AS x,
             CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN y END AS y FROM l)
SELECT stock_code, lag, count(x) AS pairs, round(CASE WHEN min(x) < max(x) AND min(y) < max(y) THEN corr(x, y) END, 4) AS corr
FROM p GROUP BY stock_code, lag""")
def event_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events of a day are the mentions, its last event the day's quote."""
    e = _quoted(read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "value"))
    days = e.groupBy("stock_code", "day").agg(F.count(F.lit(1)).alias("mentions"),
                                              F.max_by("change_pct", F.struct("ts", "event_id")).alias("change_pct"))
    return heat.event_corr(days, MAX_LAG).withColumn("corr", F.round("corr", 4))
