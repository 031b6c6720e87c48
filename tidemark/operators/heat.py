"""Topic heat, chain heat and event-performance correlation.

Mentions and chain rows are reduced to their grouping keys and stock before they meet the
quotes, so a stock with a third of all rows is one row per task ahead of the shuffle, and
the join sees one quote per stock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def topic_heat(mentions: DataFrame, quotes: DataFrame, topic: str = "topic", stock: str = "stock_code",
               change: str = "change_pct", volume: str = "volume") -> DataFrame:
    """Per topic its mentions, the volume of the stocks mentioned (each once) and their
    volume-weighted change; stocks without a quote or a change count as mentions only."""
    per = mentions.groupBy(topic, stock).agg(F.count(F.lit(1)).alias("n"))
    j = per.join(quotes.select(stock, volume, change), stock, "left")
    moved = F.col(change).isNotNull() & F.col(volume).isNotNull()
    return j.groupBy(topic).agg(
        F.sum("n").alias("mentions"), F.sum(volume).alias("volume"),
        (F.sum(F.when(moved, F.col(volume) * F.col(change))) / F.nullif(F.sum(F.when(moved, F.col(volume))), F.lit(0))).alias("weighted_change"))


def chain_heat(chains: DataFrame, quotes: DataFrame, keys: tuple[str, ...] = ("chain_ic", "segment"),
               stock: str = "stock_code", change: str = "change_pct", volume: str = "volume") -> DataFrame:
    """Per chain and segment its stocks, their volume, mean change and the share of
    those with a change that advanced; a stock counts once per segment."""
    j = chains.select(*keys, stock).distinct().join(quotes.select(stock, volume, change), stock, "left")
    return j.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("stocks"), F.sum(volume).alias("volume"), F.avg(change).alias("mean_change"),
        F.avg((F.col(change) > 0).cast("int")).alias("advancing"))


def _corr(x: Column, y: Column) -> Column:
    """Correlation of the pairs without nulls; null where either side does not vary."""
    pair = x.isNotNull() & y.isNotNull()
    x, y = F.when(pair, x.cast("double")), F.when(pair, y.cast("double"))
    return F.when((F.min(x) < F.max(x)) & (F.min(y) < F.max(y)), F.corr(x, y))


def event_corr(days: DataFrame, max_lag: int, stock: str = "stock_code", day: str = "day",
               mentions: str = "mentions", change: str = "change_pct") -> DataFrame:
    """Per stock and lag 0..max_lag the pairs and the correlation of a day's change with
    the mentions that many of the stock's days before.  ``days`` has one row per stock and day."""
    w = Window.partitionBy(stock).orderBy(day)
    lags = F.array(*[F.struct(F.lit(k).alias("lag"), F.lag(mentions, k).over(w).alias("x")) for k in range(max_lag + 1)])
    d = days.select(stock, F.col(change).alias("y"), lags.alias("lags")).select(stock, "y", F.explode("lags").alias("l"))
    return d.groupBy(stock, F.col("l.lag").alias("lag")).agg(
        F.count(F.when(F.col("l.x").isNotNull() & F.col("y").isNotNull(), 1)).alias("pairs"), _corr(F.col("l.x"), F.col("y")).alias("corr"))
