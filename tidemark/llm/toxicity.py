"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the n-grams of 4 to 6 characters of the lower-cased text, white space as one
blank, hashed to 2**20 buckets; a feature is there or not.  Over the labelled sample each
bucket gets the log ratio of its document frequencies among toxic and other texts; the
strongest buckets are kept, their presence times that ratio goes into a logistic
regression, and a document's score is its probability.

The fit takes a bounded sample of the labelled rows (``SAMPLE_TOXIC`` and
``SAMPLE_CLEAN``, by hash of the doc_id); every document is scored over its whole text.  Rows
weigh as many labelled rows of their class as they stand for, so the score means the same
at every input size, and toxic ones ``TOXIC_COST`` times that: a toxic text missed costs as
much as so many clean ones taken for toxic.

Edge cases: null and empty texts have no feature and get the model's score for that;
labelled rows without a doc_id or label are left out; several labels of a document count
as toxic if one is; without labels of both classes the score is the share of toxic labels
(0 without any); copies get equal scores; rows without a doc_id are scored and not held
out; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, doc_texts, staged

SIZES = (4, 5, 6)
BITS = 20
#: Rows of each class that the fit takes at most.
SAMPLE_TOXIC, SAMPLE_CLEAN = 5_000, 10_000
#: A kept bucket is in so many sample documents at least; so many buckets are kept at most.
MIN_DOCS, KEPT = 5, 8_192
#: ... with a log ratio of this size at least, either way.
MIN_RATIO = 1.5
SMOOTHING = 1.0
PENALTY = 0.001
THRESHOLD = 0.3
TOXIC_COST = 8.0
#: Characters that are hashed at once.
BLOCK = 1 << 20
HELD_OUT, FOLDS = 2, 4


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


class Features:
    """The features of one text after another; ``keep``: only buckets true there."""

    def __init__(self, keep: np.ndarray | None = None):
        self.keep, self.seat = keep, np.zeros(1 << BITS, np.int32)

    def _distinct(self, buckets: np.ndarray) -> np.ndarray:
        """Each bucket once: every occurrence takes its seat, and who still sits there is kept."""
        order = np.arange(len(buckets), dtype=np.int32)
        self.seat[buckets] = order
        return buckets[self.seat[buckets] == order]

    def of(self, text: str) -> np.ndarray:
        """Buckets of the n-grams present, each once; a long text goes in overlapping parts."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        found = []
        for a in range(0, len(codes), BLOCK):
            c = codes[max(0, a - SIZES[-1] + 1):a + BLOCK].astype(np.uint64)
            c[(c >= 9) & (c <= 13)] = 32
            h = c
            for n in range(2, SIZES[-1] + 1):
                h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[n - 1:]
                if n in SIZES:
                    b = (((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)).astype(np.int32)
                    found.append(b if self.keep is None else b[self.keep[b]])
            if len(codes) > BLOCK:
                found = [self._distinct(np.concatenate(found))]
        return self._distinct(np.concatenate(found)) if found else np.zeros(0, np.int32)


class Model:
    """``weights`` by bucket and ``bias``; without features ``bias`` alone is the logit."""

    def __init__(self, weights: np.ndarray | None, bias: float):
        self.weights, self.bias = weights, bias
        self.features = None

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "features": None}

    def scores(self, texts: list[str]) -> np.ndarray:
        z = np.full(len(texts), self.bias)
        if self.weights is not None:
            self.features = self.features or Features(self.weights != 0)
            for i, t in enumerate(texts):
                z[i] += self.weights[self.features.of(t)].sum(dtype=np.float64)
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def _sample(labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, toxic) of at most SAMPLE_TOXIC and SAMPLE_CLEAN labelled documents outside the held-out fold, and how many each class has."""
    one = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id").cast("long")))
           .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    one = staged(one, "toxic-labels")
    sizes = {r["toxic"]: r["count"] for r in one.groupBy("toxic").count().collect()}  # two rows
    return bounded_sample(one.filter("toxic = 1"), SAMPLE_TOXIC, "doc_id").unionByName(bounded_sample(one.filter("toxic = 0"), SAMPLE_CLEAN, "doc_id")), sizes


def _sorted(place: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(place)
    return place[order], value[order]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model, from whole texts of a bounded sample of the labelled documents."""
    sample, sizes = _sample(labels)
    rows = doc_texts(docs).join(F.broadcast(sample), "doc_id").select("toxic", "text")  # SAMPLE_TOXIC + SAMPLE_CLEAN rows at most are sent

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, features = np.zeros((2, 1 << BITS), np.int32), np.zeros(2, np.int64), Features()
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                n[y][features.of(t.as_py())] += 1
                total[y] += 1
        at = np.flatnonzero(n.any(axis=0))
        # Bucket -1 holds the numbers of documents.
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at]), pa.array(np.r_[total[0], n[0][at]]), pa.array(np.r_[total[1], n[1][at]])], ["bucket", "clean", "toxic"])

    counts = (rows.mapInArrow(count, "bucket long, clean long, toxic long")
              .groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
              .filter(f"bucket = -1 OR clean + toxic >= {MIN_DOCS}"))
    both = staged(counts, "ngram-counts")
    total = both.filter("bucket = -1").first()
    n0, n1 = (total["clean"], total["toxic"]) if total else (0, 0)
    if not n0 or not n1:
        share = n1 / (n0 + n1) if n0 + n1 else 0.0
        return Model(None, 700.0 if share == 1 else -700.0)
    ratio = (F.log((F.col("toxic") + SMOOTHING) / (n1 + 2 * SMOOTHING)) - F.log((F.col("clean") + SMOOTHING) / (n0 + 2 * SMOOTHING)))
    kept = (both.filter("bucket >= 0").select("bucket", ratio.alias("r"), (F.abs(ratio) * F.sqrt(F.col("clean") + F.col("toxic"))).alias("strength"))
            .filter(F.abs("r") >= MIN_RATIO)
            .orderBy(F.desc("strength"), "bucket").limit(KEPT).collect())  # KEPT rows at most
    ratios = np.zeros(1 << BITS, np.float32)
    ratios[[r["bucket"] for r in kept]] = [r["r"] for r in kept]
    if not kept:
        return Model(None, math.log(n1 / n0))
    place = np.cumsum(ratios != 0) - 1
    width = int(place[-1]) + 1

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(ratios != 0)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([features.of(t.as_py()) for t in b.column(1)], pa.list_(pa.int32()))], ["toxic", "buckets"])

    vector = F.udf(lambda buckets: Vectors.sparse(width, *_sorted(place[buckets], ratios[buckets].astype(float))), VectorUDT())
    x = rows.mapInArrow(present, "toxic int, buckets array<int>").select(F.col("toxic").cast("double").alias("label"), vector("buckets").alias("features"))
    toxic, clean = TOXIC_COST * sizes[1] / n1, sizes[0] / n0
    scale = (n0 + n1) / (toxic * n1 + clean * n0)  # one on average, so the penalty keeps its meaning
    x = x.withColumn("weight", F.when(F.col("label") == 1, toxic * scale).otherwise(clean * scale))
    lr = LogisticRegression(regParam=PENALTY, standardization=False, maxIter=40, weightCol="weight").fit(x)
    weights = np.zeros(1 << BITS, np.float32)
    at = np.flatnonzero(ratios)
    weights[at] = lr.coefficients.toArray() * ratios[at]
    return Model(weights, float(lr.intercept))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``, over whole texts."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sent.value.scores(texts), pa.float64())], ["doc_id", "score"])

    scored = doc_texts(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
