"""Keywords per topic by TF-IDF (M2, A9, W6, W7), as grouped aggregates.

Per topic of N documents:
  1. vocabulary = the ``n`` terms with the largest total count (ties by term);
  2. idf = ln((1 + N) / (1 + df)) + 1, df counted within the topic;
  3. weight = tf * idf, L2-normalised per document over the kept terms only;
  4. score = mean weight over all N documents (a document without a kept term adds 0);
  5. terms ranked by score descending, then term.

Everything is a hash aggregate or a join on (topic, term) / (topic, doc); the
vocabulary cut is ``row_number() <= n`` (``WindowGroupLimit``), so a hot topic never
sends more than n terms per map task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import N_KEYWORDS
from ..session import staged
from .dedupe import top_n


def _terms(df: DataFrame, tokens: str) -> DataFrame:
    """One row per token.  ``explode_outer`` + a null filter rather than ``explode``:
    for an inner explode Catalyst infers ``size(tokens) > 0`` and pushes it down to the
    scan, which would run the whole cleaning and tokenizing chain twice."""
    rest = [c for c in df.columns if c != tokens]
    return (df.select(*rest, F.explode_outer(tokens).alias("term"))
            .where(F.col("term").isNotNull()))


def term_counts(df: DataFrame, topic: str | Sequence[str] | dict[str, str], doc: str,
                tokens: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Per-document term counts and topic sizes.

    ``topic`` is a column, a list of key columns, or ``{level: column}`` for several
    topic levels at once.  With levels, each document is tokenized and counted once
    (its topic columns ride along in the grouping key, being functions of the document),
    and only the counted rows are fanned out to (level, topic).
    Returns (tf rows (keys..., doc, term, tf), topic sizes (keys..., __N), keys).
    """
    if isinstance(topic, dict):
        cols = list(topic.values())
        lv = F.explode(F.array(*[F.struct(F.lit(name).alias("level"), F.col(c).alias("topic"))
                                 for name, c in topic.items()])).alias("__lv")
        keys = ["level", "topic"]
        per_doc = (_terms(df.select(doc, *cols, tokens), tokens)
                   .groupBy(doc, *cols, "term").agg(F.count(F.lit(1)).alias("tf")))
        tf = per_doc.select(doc, "term", "tf", lv).select("__lv.level", "__lv.topic", doc, "term", "tf")
        docs = df.select(doc, lv).select("__lv.level", "__lv.topic")
        tf, docs = tf.where(F.col("topic").isNotNull()), docs.where(F.col("topic").isNotNull())
    else:
        keys = [topic] if isinstance(topic, str) else list(topic)
        base = df.where(F.col(keys[-1]).isNotNull())
        tf = (_terms(base.select(*keys, doc, tokens), tokens)
              .groupBy(*keys, doc, "term").agg(F.count(F.lit(1)).alias("tf")))
        docs = base.select(*keys)
    n_docs = docs.groupBy(*keys).agg(F.count(F.lit(1)).alias("__N"))
    return tf, n_docs, keys


def topic_keywords(df: DataFrame, topic: str | Sequence[str] | dict[str, str], doc: str,
                   tokens: str, n: int = N_KEYWORDS) -> DataFrame:
    """(topic keys..., rank, term, score) for every non-empty topic; ``tokens`` is an array
    column.  With ``topic`` given as ``{level: column}`` the keys are (level, topic)."""
    tf, n_docs, keys = term_counts(df, topic, doc, tokens)
    # Counted once, read twice; the vocabulary (n terms a topic) is staged as well, so that
    # its size is known and the counted rows need no shuffle by term to meet it.
    tf = staged(tf, "term-counts")
    vocab = tf.groupBy(*keys, "term").agg(F.sum("tf").alias("__ttf"), F.count(F.lit(1)).alias("__df"))
    vocab = top_n(vocab, keys, [F.desc("__ttf"), F.col("term")], n, rank_col=None)
    vocab = vocab.join(n_docs, keys).select(
        *keys, "term", "__N", (F.log((F.col("__N") + 1) / (F.col("__df") + 1)) + 1).alias("__idf"))

    w = tf.join(staged(vocab, "vocabulary"), [*keys, "term"]).withColumn("__w", F.col("tf") * F.col("__idf"))
    doc_norm = Window.partitionBy(*keys, doc)
    w = w.withColumn("__wn", F.col("__w") / F.sqrt(F.sum(F.col("__w") * F.col("__w")).over(doc_norm)))
    score = w.groupBy(*keys, "term").agg((F.sum("__wn") / F.max("__N")).alias("score"))
    rank = Window.partitionBy(*keys).orderBy(F.desc(F.round("score", 9)), F.col("term"))
    return score.withColumn("rank", F.row_number().over(rank)).select(*keys, "rank", "term", "score")
