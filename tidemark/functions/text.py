"""Text scalars as Column expressions (JVM-side, inside whole-stage codegen).

Python's ``re`` classes are Unicode-aware while Java's defaults are ASCII, so every
class is spelled out explicitly (see ``fixed.py``) and reads the same in Java regex
and RE2.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import NA_TEXTS, PY_WHITESPACE_CLASS, SAMPLE_CHARS, WORD_CLASS

WS = PY_WHITESPACE_CLASS
URL_PATTERN = rf"https?://[^{WS}]+"
NON_WORD_PATTERN = rf"[^{WORD_CLASS}{WS}]"
# A character other than newline repeated four or more times.
RUN_PATTERN = r"([^\n])\1{3,}"
STRIP_PATTERN = rf"\A[{WS}]+|[{WS}]+\z"
SIGNATURE_PATTERN = rf"(?s)\n--[{WS}]*\n.*\z"
CJK_RUN_PATTERN = r"[\x{4E00}-\x{9FFF}]{2,}"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Python's whitespace set (``str.isspace``) as a string of characters, for ``trim``.
WS_CHARS = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())


def strip(col) -> Column:
    """Trim Python whitespace from both ends.

    ``trim`` with an explicit character set (plain ``trim`` strips U+0020 only); it
    compares code points, runs without a regex, and equals ``STRIP_PATTERN``.
    """
    return F.trim(_c(col), F.lit(WS_CHARS))


def has_text(col) -> Column:
    """A value a CSV reader would not have turned into a missing value."""
    c = _c(col)
    return c.isNotNull() & ~c.isin(*NA_TEXTS)


def clean_text(col) -> Column:
    """Drop URLs, blank out symbols, squeeze runs of 4+ equal chars to 2, trim."""
    c = F.regexp_replace(_c(col), URL_PATTERN, "")
    c = F.regexp_replace(c, NON_WORD_PATTERN, " ")
    c = F.regexp_replace(c, RUN_PATTERN, "$1$1")
    return strip(c)


def article_body(col) -> Column:
    """Text before the first signature line, 3+ newlines squeezed to 2, trimmed."""
    c = F.regexp_replace(_c(col), SIGNATURE_PATTERN, "")
    c = F.regexp_replace(c, r"\n{3,}", "\n\n")
    return strip(c)


def sample_text(col, n_chars: int = SAMPLE_CHARS) -> Column:
    """First ``n_chars`` code points with newlines turned into spaces."""
    return F.translate(F.substring(_c(col), 1, n_chars), "\n", " ")


def tokenize(col, pattern: str = r"\p{L}{2,}", lower: bool = True,
             cjk_bigrams: bool = False) -> Column:
    """M1: all matches of ``pattern`` (as an array), optionally lower-cased.

    With ``cjk_bigrams`` each run of two or more CJK ideographs is also split into its
    overlapping two-character pieces, the stand-in for a dictionary segmenter.
    """
    c = F.lower(_c(col)) if lower else _c(col)
    tokens = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    if cjk_bigrams:
        runs = F.regexp_extract_all(c, F.lit(CJK_RUN_PATTERN), F.lit(0))
        pieces = F.flatten(F.transform(
            runs,
            lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1),
                                  lambda i: r.substr(i, F.lit(2)))))
        tokens = F.concat(tokens, pieces)
    return tokens
