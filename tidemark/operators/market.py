"""Company lists, daily quotes and the matched update of the stock list.

Inputs are landed JSON records (one projection per field vocabulary).  All parsing is
Column expressions; dedupe is a keyed hash aggregate (``first_wins``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import QUOTE_COLUMNS
from ..functions.market import quote_texts, roc_to_iso, to_number, to_volume
from ..functions.text import strip
from .dedupe import first_wins, union_by_priority
from .dims import resolve_code


def _field(df: DataFrame, name: str | None) -> Column:
    if name and name in df.columns:
        return F.col(f"`{name}`").cast("string")
    return F.lit(None).cast("string")


def company_list(df: DataFrame, vocab: dict, market: str, source_url: str, synced_at: str,
                 ordinal: str = "ordinal", code_map: dict | None = None) -> DataFrame:
    """Landed company records -> stock-list rows.

    name = short name unless it is null or "", else full name (checked before trimming,
    so a blank-only short name rejects the row); rows with a blank code or name drop.
    """
    short, full = _field(df, vocab["short"]), _field(df, vocab["full"])
    name = F.when(short.isNotNull() & (short != ""), short).otherwise(F.coalesce(full, F.lit("")))
    ind_code = strip(F.coalesce(_field(df, vocab["industry"]), F.lit("")))
    out = df.select(
        strip(F.coalesce(_field(df, vocab["code"]), F.lit(""))).alias("stock_code"),
        strip(name).alias("stock_name"),
        F.lit(market).alias("market"),
        ind_code.alias("industry_code"),
        resolve_code(ind_code, code_map).alias("industry_name"),
        F.lit(source_url).alias("source_url"),
        strip(F.coalesce(_field(df, vocab["as_of"]), F.lit(""))).alias("source_as_of"),
        F.lit(synced_at).alias("synced_at"),
        F.col(ordinal).alias("ordinal"))
    return out.where((F.col("stock_code") != "") & (F.col("stock_name") != ""))


def first_seen(dfs: Sequence[DataFrame], key: str = "stock_code") -> DataFrame:
    """U1/U2 + W2: union in priority order, first seen per key wins."""
    u = union_by_priority(dfs, "priority")
    return first_wins(u, [key], ["priority", "ordinal"]).drop("ordinal")


def clean_quotes(df: DataFrame, vocab: dict, ordinal: str = "ordinal") -> DataFrame:
    """Landed quote records -> (code, close, change text, change %, volume, date).

    The numbers are parsed in one projection and the texts derived in the next, so each
    regex runs once per field (Catalyst does not merge projections that would repeat a
    costly expression).
    """
    parsed = df.select(
        strip(F.coalesce(_field(df, vocab["code"]), F.lit(""))).alias("stock_code"),
        to_number(F.coalesce(_field(df, vocab["close"]), F.lit(""))).alias("close_price"),
        to_number(F.coalesce(_field(df, vocab["change"]), F.lit(""))).alias("__chg"),
        to_number(F.coalesce(_field(df, vocab["volume"]), F.lit(""))).alias("__vol"),
        roc_to_iso(F.coalesce(_field(df, vocab["date"]), F.lit(""))).alias("quote_date"),
        F.col(ordinal).alias("ordinal"))
    chg, pct = quote_texts(F.col("close_price"), F.col("__chg"))
    out = parsed.select("stock_code", "close_price", chg.alias("change_val"), pct.alias("change_pct"),
                        to_volume(F.col("__vol")).alias("volume"), "quote_date", "ordinal")
    return out.where(F.col("stock_code") != "")


def ensure_columns(df: DataFrame, columns: Sequence[tuple[str, str]] = QUOTE_COLUMNS) -> DataFrame:
    """Add each missing column as a typed null (schema evolution)."""
    for name, typ in columns:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(typ))
    return df


def update_matched(base: DataFrame, updates: DataFrame, key: str,
                   cols: Sequence[str] = tuple(c for c, _ in QUOTE_COLUMNS),
                   flag: str = "quote_matched") -> DataFrame:
    """A matched row takes every update value, nulls and "" included; unmatched rows
    keep their values; updates without a base row are dropped.  ``flag`` marks matches.
    """
    base = ensure_columns(base, [(c, str(updates.schema[c].dataType.simpleString())) for c in cols])
    u = updates.select(F.col(key).alias("__k"), F.lit(True).alias("__m"),
                       *[F.col(c).alias(f"__u_{c}") for c in cols])
    j = base.join(u, base[key] == u["__k"], "left")
    matched = F.coalesce(F.col("__m"), F.lit(False))
    sel = []
    for c in base.columns:
        sel.append(F.when(matched, F.col(f"__u_{c}")).otherwise(F.col(c)).alias(c) if c in cols
                   else F.col(c))
    return j.select(*sel, matched.alias(flag))


def load_metrics(updated: DataFrame, fetched: DataFrame, chains: DataFrame, chain: str = "chain_ic",
                 flag: str = "quote_matched") -> DataFrame:
    """(metric, value): quotes fetched, rows of the table, rows updated, chains seen."""
    table = updated.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col(flag), 1)).alias("rows_updated"))
    out = table.unpivot([], ["rows", "rows_updated"], "metric", "value")
    out = out.unionByName(fetched.agg(F.lit("rows_fetched").alias("metric"), F.count(F.lit(1)).alias("value")))
    return out.unionByName(chains.agg(F.lit("chains_seen").alias("metric"), F.count_distinct(chain).alias("value")))
