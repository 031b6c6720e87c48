"""Market-data scalars as Column expressions.

ANSI mode is on in Spark 4, so every conversion uses a ``try_`` form and yields
null where the original code would have given None or raised on bad input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import CHAIN_TITLE_SUFFIX, NUMERIC_NULL_TEXTS, ROC_YEAR_OFFSET
from .text import strip

# Plain decimal / scientific notation; rejects Java-only forms such as "1.5d".
NUMBER_PATTERN = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def roc_to_iso(col) -> Column:
    """7-char ROC ``YYYMMDD`` -> ``YYYY-MM-DD``; other lengths returned trimmed."""
    s = strip(_c(col))
    year = F.try_add(s.substr(1, 3).try_cast("int"), F.lit(ROC_YEAR_OFFSET))
    iso = F.concat_ws("-", year.cast("string"), s.substr(4, 2), s.substr(6, 2))
    return F.when(F.length(s) == 7, F.when(year.isNotNull(), iso)).otherwise(s)


def to_number(col) -> Column:
    """Trim, drop thousands commas; null texts and non-numbers become null."""
    s = F.regexp_replace(strip(_c(col)), ",", "")
    ok = ~s.isin(*NUMERIC_NULL_TEXTS) & s.rlike(NUMBER_PATTERN)
    return F.when(ok, s.try_cast("double"))


def _two_decimals(x: Column) -> Column:
    # DecimalFormat rounds like Python's "%.2f"; format_string does not.
    return F.call_function("format_number", x, F.lit("0.00"))


def fmt_change(change) -> Column:
    """Sign + two decimals, e.g. ``+1.60`` / ``-0.28``."""
    x = _c(change)
    return F.concat(F.when(x >= 0, F.lit("+")).otherwise(F.lit("")), _two_decimals(x))


def pct_value(close, change) -> Column:
    """P10 value: change / (close - change) * 100; null when the previous close is 0."""
    c, d = _c(close), _c(change)
    prev = c - d
    return F.when(prev != 0, d / prev * 100)


def fmt_pct(pct) -> Column:
    x = _c(pct)
    return F.when(x.isNull(), F.lit("")).otherwise(
        F.concat(F.when(x >= 0, F.lit("+")).otherwise(F.lit("")), _two_decimals(x), F.lit("%")))


def quote_texts(close, change) -> tuple[Column, Column]:
    """P9 + P10: (change text, change % text); both "" unless close and change exist."""
    c, d = _c(close), _c(change)
    both = c.isNotNull() & d.isNotNull()
    chg = F.when(both, fmt_change(d)).otherwise(F.lit(""))
    pct = F.when(both, fmt_pct(pct_value(c, d))).otherwise(F.lit(""))
    return chg, pct


def to_volume(col) -> Column:
    """Number -> integer, truncating."""
    return _c(col).try_cast("bigint")


def post_date(col, year: int) -> Column:
    """``M/D`` + a year -> timestamp; invalid or empty -> null."""
    return F.try_to_timestamp(F.concat(F.lit(f"{year}/"), strip(_c(col))), F.lit("yyyy/M/d"))


def chain_topic(col, suffix: str = CHAIN_TITLE_SUFFIX) -> Column:
    """Trim, drop the chain-introduction suffix if present, trim again."""
    t = strip(_c(col))
    cut = strip(t.substr(F.lit(1), F.length(t) - len(suffix)))
    return F.when(t.endswith(suffix), cut).otherwise(t)


def segment_code(col) -> Column:
    """``companyList_([0-9A-Z]+)`` at the start, else the id without the prefix."""
    c = _c(col)
    m = F.regexp_extract(c, r"^companyList_([0-9A-Z]+)", 1)
    return F.when(m != "", m).otherwise(F.replace(c, F.lit("companyList_"), F.lit("")))
