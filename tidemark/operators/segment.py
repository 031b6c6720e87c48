"""Word segmentation with a lexicon learned from the corpus (M1).

Scripts without spaces give runs of letters that hold many words.  The lexicon is made of
the n-grams of those runs that hold together and stand in varied company:

* cohesion: the least, over all places to cut an n-gram in two, of
  ln(n(gram) * chars / (n(left) * n(right)));
* branching entropy: that of the characters before it, and of those after it, an end of the
  run being one more character.

Runs are counted first, so that the n-grams of a frequent run are cut once.  A run is then
cut along the path through the lattice of its words with the greatest sum of ln(n / chars);
single characters are always allowed.  The lexicon is at most ``MAX_WORDS`` rows, those with
the highest counts, which bounds what is sent to the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import CJK_RUN_PATTERN, tokenize
from ..session import staged

#: Characters of a word at most; counts, cohesion and entropy that it needs.
MAX_CHARS, MIN_COUNT, MIN_COHESION, MIN_ENTROPY = 4, 20, 1.0, 0.5
#: Words of the lexicon at most.
MAX_WORDS = 500_000


def letter_runs(df: DataFrame, text: str, pattern: str) -> DataFrame:
    """(run, n): the different lower-cased runs of a pattern and how often they occur."""
    runs = df.select(F.explode_outer(F.regexp_extract_all(F.lower(F.col(text)), F.lit(pattern), F.lit(0))).alias("run"))
    return runs.where(F.col("run").isNotNull()).groupBy("run").agg(F.count(F.lit(1)).alias("n"))


def lexicon_scores(runs: DataFrame, max_chars: int = MAX_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(gram, n, cohesion, left_entropy, right_entropy) of the n-grams that occur ``min_count`` times.

    Single characters have no cohesion (null) and are all kept.
    """
    size = F.length("run")
    starts = F.sequence(F.lit(1), size)
    cut = F.flatten(F.transform(starts, lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(max_chars), size - i + 1)), lambda m: F.struct(
            F.col("run").substr(i, m).alias("gram"),
            F.when(i > 1, F.col("run").substr(i - 1, F.lit(1))).otherwise("").alias("before"),
            F.col("run").substr(i + m, F.lit(1)).alias("after")))))
    grams = runs.where(size > 0).select("n", F.explode(cut).alias("g")).select("n", "g.*")
    met = staged(grams.groupBy("gram", "before", "after").agg(F.sum("n").alias("n")), "grams")
    counts = staged(met.groupBy("gram").agg(F.sum("n").alias("n")).where((F.col("n") >= min_count) | (F.length("gram") == 1)), "gram-counts")
    chars = counts.where(F.length("gram") == 1).agg(F.sum("n").alias("chars"))

    def entropy(side: str) -> DataFrame:
        by = met.groupBy("gram", side).agg(F.sum("n").alias("c")).groupBy("gram")
        return by.agg((F.log(F.sum("c")) - F.sum(F.col("c") * F.log("c")) / F.sum("c")).alias(f"{side}_entropy"))

    # Every part of a kept n-gram is at least as frequent, so it is kept as well.
    long = counts.where(F.length("gram") > 1)
    split = F.explode(F.transform(F.sequence(F.lit(1), F.length("gram") - 1), lambda i: F.struct(
        F.col("gram").substr(F.lit(1), i).alias("left"), F.col("gram").substr(i + 1, F.length("gram")).alias("right"))))
    parts = long.select("gram", "n", split.alias("p")).select("gram", "n", "p.*")
    parts = (parts.join(counts.select(F.col("gram").alias("left"), F.col("n").alias("n_left")), "left")
             .join(counts.select(F.col("gram").alias("right"), F.col("n").alias("n_right")), "right").crossJoin(F.broadcast(chars)))  # one row
    cohesion = parts.groupBy("gram").agg(F.min(F.log(F.col("n") * F.col("chars") / (F.col("n_left") * F.col("n_right").cast("double")))).alias("cohesion"))
    return (counts.join(cohesion, "gram", "left").join(entropy("before"), "gram").join(entropy("after"), "gram")
            .select("gram", "n", "cohesion", F.col("before_entropy").alias("left_entropy"), F.col("after_entropy").alias("right_entropy")))


def words_of_lexicon(scores: DataFrame) -> Column:
    """Rows of ``lexicon_scores`` that are words; single characters always are."""
    return F.length("gram").eqNullSafe(1) | ((F.col("cohesion") >= MIN_COHESION) & (F.least("left_entropy", "right_entropy") >= MIN_ENTROPY))


@dataclass
class Lexicon:
    """Log share of each word, and of a character that the corpus does not have."""

    weights: Mapping[str, float]
    unknown: float
    longest: int

    def cut(self, run: str) -> list[str]:
        """The best path; of equal ones (to 9 places) that with the longer last word."""
        best, back = [0.0], [0]
        for j in range(1, len(run) + 1):
            choices = []
            for m in range(1, min(self.longest, j) + 1):
                w = self.weights.get(run[j - m:j], self.unknown if m == 1 else None)
                if w is not None:
                    choices.append((round(best[j - m] + w, 9), m, best[j - m] + w))
            _, m, score = max(choices)
            best.append(score)
            back.append(m)
        out, j = [], len(run)
        while j:
            out.append(run[j - back[j]:j])
            j -= back[j]
        return out[::-1]


def learn(scores: DataFrame, most: int = MAX_WORDS) -> Lexicon:
    """The lexicon of the words among ``scores``."""
    words = scores.where(words_of_lexicon(scores))
    chars = scores.where(F.length("gram") == 1).agg(F.sum("n")).first()[0] or 1
    rows = words.orderBy(F.desc("n"), "gram").select("gram", "n").limit(most).toArrow().to_pydict()  # a bounded lexicon
    weights = {g: math.log(n / chars) for g, n in zip(rows["gram"], rows["n"], strict=True)}
    return Lexicon(weights, math.log(0.5 / chars), max(map(len, weights), default=1))


def segment_runs(runs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(run, n, words): each run of (run, n) cut into words."""
    sent = runs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [sent.value.cut(x) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(words, pa.list_(pa.string()))], ["run", "n", "words"])

    return runs.select("run", "n").mapInArrow(run, "run string, n long, words array<string>")


def segmented_tokens(df: DataFrame, text: str, out: str = "tokens", pattern: str = r"\p{L}{2,}",
                     run_pattern: str = CJK_RUN_PATTERN) -> DataFrame:
    """M1: ``df`` with the words of ``text``: runs of ``run_pattern`` cut by the lexicon of the whole table.

    Tokens are the matches of ``pattern`` as before; the words of two and more characters
    take the place of the runs.  A table without such runs learns nothing and needs no cut.
    """
    tokens = tokenize(text, pattern)
    lexicon = learn(lexicon_scores(staged(letter_runs(df, text, run_pattern), "letter-runs")))
    if not lexicon.weights:
        return df.withColumn(out, tokens)
    sent = df.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("array<string>")
    def words(runs):
        return runs.map(lambda x: [w for r in x for w in sent.value.cut(r) if len(w) > 1])

    # Runs leave their place in the text first, so that a token beside one is not joined to it.
    lower = F.lower(F.col(text))
    rest = F.regexp_extract_all(F.regexp_replace(lower, run_pattern, " "), F.lit(pattern), F.lit(0))
    return df.withColumn(out, F.concat(rest, words(F.coalesce(F.regexp_extract_all(lower, F.lit(run_pattern), F.lit(0)), F.array().cast("array<string>")))))
