"""Keyed dedupe, top-k per group, claims and resume sets.

One-winner-per-key operators (first wins, last wins, URL claim) are hash aggregates
with ``min_by`` / ``max_by``: Spark combines them map-side, so a key holding a third
of all rows collapses to one row per map task before the shuffle.  Top-n with n > 1
uses ``row_number() <= n``, which Spark plans as ``WindowGroupLimit`` on both sides
of the exchange, so a hot group ships at most n rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    ordkey = F.struct(*_cols(order))
    agg = df.groupBy(*keys).agg(pick(F.struct(*[F.col(c) for c in rest]), ordkey).alias("__w"))
    return agg.select(*keys, *[F.col("__w")[c].alias(c) for c in rest])


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Per key, the row with the smallest ``order`` (e.g. source priority, ordinal)."""
    return _one_per_key(df, keys, order, F.min_by)


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Per key, the row with the largest ``order`` (insert-or-replace semantics)."""
    return _one_per_key(df, keys, order, F.max_by)


def union_by_priority(dfs: Sequence[DataFrame], priority_col: str = "priority") -> DataFrame:
    """Union of sources tagged with their position in the list."""
    out = None
    for i, d in enumerate(dfs):
        d = d.withColumn(priority_col, F.lit(i))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence, n: int,
          rank_col: str | None = "rank") -> DataFrame:
    """The first ``n`` rows per group by ``order`` (ties broken by ``order``)."""
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    out = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n)
    return out.withColumnRenamed("__rn", rank_col) if rank_col else out.drop("__rn")


def claim(df: DataFrame, url: str, order: Sequence) -> DataFrame:
    """Each URL belongs to the first finder in ``order`` across the whole run."""
    return first_wins(df, [url], order)


def pending(requested: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Requested work not yet done."""
    return requested.join(done.select(key), key, "left_anti")


def done_requested(requested: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Done ∩ requested."""
    return requested.select(key).intersect(done.select(key))


def all_done(requested: DataFrame, done: DataFrame, key: str) -> bool:
    """Every requested key is done (the difference is empty)."""
    return pending(requested.select(key), done, key).limit(1).count() == 0
