"""Quality rules as a short-circuit cascade, in built-in expressions only.

Every rule rejects by a Column over a document's statistics.  ``order_rules`` times each
rule and counts its rejections on a small sample, and the cascade then runs the rules by
rejections per cost, so that most rejected documents leave after the cheapest useful rule.
The order never changes a verdict.

Edge cases: a null text counts as empty (no words) and fails the length rule; repeated
rows each get their own verdict; other columns are neither read nor needed; an empty
table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NON_SPACE_CLASS, let, staged, text_of, words_of

#: Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
WINDOW = 3

#: Parameters of the method's own rules, as whole percentages.
MAX_SYMBOL_PCT = 10      # symbols per word
MAX_DUP_LINE_PCT = 50    # repeated lines per line
MAX_UPPER_PCT = 40       # A-Z per word character
MAX_SHOUT_PCT = 20       # exclamation marks per word
MIN_WORD_CHARS_PCT, MAX_WORD_CHARS_PCT = 250, 1400  # mean word length times 100

#: Documents that the order of the rules is estimated on; no verdict depends on it.
SAMPLE_ROWS = 512
#: ... and their length, so that the sample is small in bytes too.
SAMPLE_CHARS = 20_000


def _chars(text: Column, which: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, which, ""))).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(NON_SPACE_CLASS))


def _window_hashes(words: Column) -> Column:
    return F.when(F.size(words) < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW),
                    lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])))


def _covered(positions: Column) -> Column:
    """Words in windows that start at ``positions`` (ascending), overlaps once."""
    steps = F.transform(positions, lambda p, k: F.coalesce(F.least(F.lit(WINDOW), F.get(positions, k + 1) - p), F.lit(WINDOW)))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def repeat_words(words: Column) -> Column:
    """Words in windows of three that occur at least twice in the text.

    A sort by (window hash, position) brings equal windows together: n log n in a
    text's words.  Texts without a repeated window stop at a distinct count.
    """
    def repeated(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def among(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            again = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
            return F.sort_array(F.transform(again, lambda x: x["i"]))

        return let(let(ranked, among), _covered)

    return let(words, lambda ws: let(_window_hashes(ws), lambda hs: F.when(
        F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(repeated(hs))))


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def dup_lines(text: Column) -> Column:
    return let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


@dataclass(frozen=True)
class Doc:
    """What rules read: the text, its words and number of words, and statistics by name.

    A statistic is a column where one is at hand, else its expression over the text, so
    that a rule that is not reached costs nothing.
    """

    text: Column
    words: Column
    n_words: Column
    have: frozenset = frozenset()

    def __getattr__(self, name: str) -> Column:
        if name not in _STATISTICS:
            raise AttributeError(name)
        return F.col(name) if name in self.have else _STATISTICS[name](self)


_STATISTICS = {
    "word_chars": lambda d: word_chars(d.words),
    "n_symbols": lambda d: _chars(d.text, SYMBOLS),
    "n_dup_lines": lambda d: dup_lines(d.text),
    "n_repeat_words": lambda d: repeat_words(d.words),
    "n_lines": lambda d: F.size(_lines(d.text)),
    "n_upper": lambda d: _chars(d.text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "n_shout": lambda d: F.length(d.text) - F.length(F.replace(d.text, F.lit("!"), F.lit(""))),
}


@dataclass(frozen=True)
class Rule:
    """Rejects a document where ``reject`` (a function of ``Doc``) holds."""

    name: str
    reject: Callable[[Doc], Column]

    def column(self, doc: Doc) -> Column:
        return F.coalesce(self.reject(doc), F.lit(False))


def with_words(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__words`` and ``__n_words``, which nearly every rule reads."""
    return docs.withColumn("__words", words_of(text_of())).withColumn("__n_words", F.size("__words").cast("long"))


def _doc(have: Sequence[str] = ()) -> Doc:
    return Doc(text_of(), F.col("__words"), F.col("__n_words"), frozenset(have))


BASE_RULES = (Rule("few_words", lambda d: d.n_words < MIN_WORDS),
              Rule("repeated_words", lambda d: 100 * d.n_repeat_words > MAX_REPEAT_PCT * d.n_words))
METHOD_RULES = (Rule("symbols", lambda d: 100 * d.n_symbols > MAX_SYMBOL_PCT * d.n_words),
                Rule("repeated_lines", lambda d: 100 * d.n_dup_lines > MAX_DUP_LINE_PCT * d.n_lines),
                Rule("upper_case", lambda d: 100 * d.n_upper > MAX_UPPER_PCT * d.word_chars),
                Rule("shouting", lambda d: 100 * d.n_shout > MAX_SHOUT_PCT * d.n_words),
                Rule("short_words", lambda d: 100 * d.word_chars < MIN_WORD_CHARS_PCT * d.n_words),
                Rule("long_words", lambda d: 100 * d.word_chars > MAX_WORD_CHARS_PCT * d.n_words))


def order_rules(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` by rejections per second on a sample of at most ``sample_rows`` documents.

    Ties keep the given order.  The sample only sets the order of evaluation.
    """
    # collect() on a limit reads the first partitions only; a limit inside a larger plan would read from all.
    few = docs.select(text_of().alias("text")).filter(F.length("text") <= SAMPLE_CHARS).limit(sample_rows).collect()
    sample = docs.sparkSession.createDataFrame(few, "text string")
    sample = staged(with_words(sample), "rule-sample").coalesce(1)
    doc = _doc()

    def seconds(c: Column) -> tuple[float, int]:
        began = time.perf_counter()
        hits = sample.agg(F.sum(c.cast("int"))).first()[0] or 0
        return time.perf_counter() - began, hits

    nothing = F.length("text") + doc.n_words < 0
    seconds(nothing)  # the first read and its code are nobody's cost
    floor, _ = seconds(nothing)
    measured = []
    for r in rules:
        seconds(r.column(doc))  # compile
        took, hits = seconds(r.column(doc))
        measured.append(hits / max(took - floor, 1e-4))
    return [r for _, r in sorted(zip(measured, rules, strict=True), key=lambda x: -x[0])]


def cascade(doc: Doc, rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects the document, null if none does.

    CASE evaluates its branches in order and stops at the first that holds.
    """
    out = None
    for r in rules:
        out = F.when(r.column(doc), r.name) if out is None else out.when(r.column(doc), r.name)
    return out if out is not None else F.lit(None).cast("string")


def keep_quality(docs: DataFrame, rules: Sequence[Rule] = BASE_RULES + METHOD_RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, columns as they are."""
    ordered = order_rules(docs, rules)
    # A filter moves below a projection and takes its expressions along, once for each use; so the words are bound here.
    return docs.filter(let(words_of(text_of()), lambda ws: cascade(Doc(text_of(), ws, F.size(ws).cast("long")), ordered)).isNull())


def quality_report(docs: DataFrame, rules: Sequence[Rule] = METHOD_RULES) -> DataFrame:
    """One row per document: the contract's statistics, ``base_failed`` and ``kept``.

    The statistics are asked for in every row, so only the method's own rules cascade
    here, and only for rows that the base rules keep.
    """
    ordered = order_rules(docs, rules)
    named = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    d = with_words(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")))
    d = d.select("*", *[_STATISTICS[k](_doc()).alias(k) for k in named])
    n = F.col("__n_words")
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * n)
    kept = F.when(failed, F.lit(False)).otherwise(cascade(_doc(named), ordered).isNull())
    return d.select("doc_id", n.alias("n_words"), *named, failed.alias("base_failed"), kept.alias("kept"))


ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
win AS (SELECT rid, i, [ws[i], ws[i + 1], ws[i + 2]] AS g
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c >= 2),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
ln AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
s AS (SELECT d.rid, doc_id, t, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
        length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
        length(t) - length(replace(t, '!', '')) AS n_shout
      FROM d JOIN w USING (rid) JOIN ln USING (rid) LEFT JOIN cov USING (rid)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > {MAX_SYMBOL_PCT} * n_words OR 100 * n_dup_lines > {MAX_DUP_LINE_PCT} * n_lines
       OR 100 * n_upper > {MAX_UPPER_PCT} * word_chars OR 100 * n_shout > {MAX_SHOUT_PCT} * n_words
       OR 100 * word_chars < {MIN_WORD_CHARS_PCT} * n_words OR 100 * word_chars > {MAX_WORD_CHARS_PCT} * n_words) AS kept
FROM b
"""
