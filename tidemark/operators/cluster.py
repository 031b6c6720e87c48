"""Embedding, reduction, neighbour graph and two-level Ward topics at Spark scale.

* ``embed``: tokens -> HashingTF -> (IDF) -> L2 Normalizer; cached by content hash.
* ``reduce``: Spark ML PCA (the covariance is dim x dim, independent of row count).
* ``knn_graph``: exact cosine top-k.  Rows are hashed into B large blocks; every
  (query block, candidate block) pair is one cogroup task that multiplies two blocks a strip
  at a time and keeps k candidates per query row, so no task ever holds more than two blocks
  and a strip, and no group emits all pairs; a row is sent 2 B times.  A final
  ``row_number() <= k`` merges the per-block lists.
* ``ward_merges``: weighted Ward over a small table of clusters (n, sum x) with the
  nearest-neighbour chain; ``hierarchy`` brings tables of any size down to it, exactly.
* ``cut``: ``maxclust``-style cuts of the merge table; cuts at two levels nest.
* ``ch_score`` / ``best_k``: Calinski-Harabasz from grouped statistics.
* ``assign_topics``: nearest centroid for new documents (centroids are topic-sized).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, IDF, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import tokenize
from ..session import scratch_path, staged
from .dedupe import top_n

#: Session setting that names a lasting embedding cache; unset: a new folder for each call.
CACHE_SETTING = "spark.tidemark.embeddingCache"


# ------------------------------------------------------------------ M3 / S9
def cache_folder(spark: SparkSession) -> str:
    """The embedding cache that the session names, else a new shared folder."""
    return spark.conf.get(CACHE_SETTING, None) or scratch_path(spark, "embedding-cache")


def text_encoder(dim: int = 1024, idf: bool = False, tokens: str = "tokens",
                 out: str = "features") -> Pipeline:
    stages = [HashingTF(inputCol=tokens, outputCol="__tf", numFeatures=dim)]
    if idf:
        stages.append(IDF(inputCol="__tf", outputCol="__tfidf"))
    stages.append(Normalizer(inputCol=stages[-1].getOutputCol(), outputCol=out, p=2.0))
    return Pipeline(stages=stages)


def embed(df: DataFrame, text: str = "text", encoder: PipelineModel | Pipeline | None = None,
          out: str = "embedding", dim: int = 1024) -> DataFrame:
    """M3: unit-length document vectors as ``array<float>`` (``out``)."""
    t = df.withColumn("tokens", tokenize(text, r"\p{L}{2,}", cjk_bigrams=True))
    enc = encoder or text_encoder(dim)
    model = enc.fit(t) if isinstance(enc, Pipeline) else enc
    v = model.transform(t)
    return v.withColumn(out, vector_to_array("features", "float32")).drop(
        "tokens", "features", "__tf", "__tfidf")


def embed_cached(spark: SparkSession, df: DataFrame, cache_path: str, model_id: str,
                 text: str = "text", out: str = "embedding", dim: int = 1024,
                 prepare=None) -> DataFrame:
    """Embeddings keyed by (model, sha256(text)); only cache misses are encoded,
    and they are appended to the cache.  The encoder here is stateless (no IDF), so a
    cached vector never goes stale.

    ``prepare`` (a Column -> Column function, e.g. text cleaning) is applied to the
    misses only, before encoding: the key is the hash of the raw text, so documents
    already in the cache are neither cleaned nor encoded again.  Include the version of
    ``prepare`` in ``model_id``.
    """
    keyed = df.withColumn("text_hash", F.sha2(F.col(text), 256))
    cache = _cached_vectors(spark, cache_path, model_id, out)
    todo = keyed.select("text_hash", text).dropDuplicates(["text_hash"])
    if cache is not None:
        todo = todo.join(cache.select("text_hash"), "text_hash", "left_anti")
    if prepare is not None:
        todo = todo.withColumn(text, prepare(F.col(text)))
    new = embed(todo, text, out=out, dim=dim).select(F.lit(model_id).alias("model"), "text_hash", out)
    new.write.mode("append").parquet(cache_path)
    return keyed.drop(text).join(_cached_vectors(spark, cache_path, model_id, out), "text_hash")


def _cached_vectors(spark: SparkSession, cache_path: str, model_id: str, out: str) -> DataFrame | None:
    """(text_hash, vector) of a model, one row per hash; None where there is no cache yet.

    Two jobs at a time, or a job that ran again, may append a hash twice; the vectors are
    equal then and one of them counts.
    """
    try:
        cache = spark.read.schema(f"model string, text_hash string, {out} array<float>").parquet(cache_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    rows = cache.where(F.col("model") == model_id).select("text_hash", out, F.col("_metadata.file_path").alias("file"))
    # Hashes meet, not vectors: those in several files are few, and one of their files counts.
    twice = rows.groupBy("text_hash").agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("first")).where("n > 1")
    twice = staged(twice.select("text_hash", "first"), "embedded-twice")
    return rows.join(twice, "text_hash", "left").where("first IS NULL OR file = first").select("text_hash", out)


# ------------------------------------------------------------------ M4
def reduce(df: DataFrame, vec: str, k: int, out: str = "reduced") -> DataFrame:
    """M4: PCA to k dimensions (``vec`` may be an array or a vector column)."""
    src = df.withColumn("__v", array_to_vector(vec)) if _is_array(df, vec) else df.withColumn("__v", F.col(vec))
    model = PCA(k=k, inputCol="__v", outputCol=out).fit(src)
    return model.transform(src).drop("__v")


def _is_array(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.typeName() == "array"


# ------------------------------------------------------------------ M5
#: Rows of a block at most, and blocks at least, so that their pairs are enough tasks for small tables too.
KNN_ROWS, KNN_BLOCKS = 65_536, 6
#: Rows of a product's sides: a task holds two blocks and such a product, whatever the table.
KNN_STEP, KNN_WIDTH = 512, 4096
#: Pairs that are multiplied in doubles at once.
KNN_PAIRS = 1 << 17


def knn_graph(df: DataFrame, key: str, vec: str, k: int, block_rows: int = KNN_ROWS,
              n_rows: int | None = None) -> DataFrame:
    """M5: exact cosine k-nearest neighbours (self excluded): (key, rank, neighbor_id, sim).

    Ties are broken by similarity rounded to 9 places, then by neighbour id.
    """
    n = n_rows if n_rows is not None else df.count()
    blocks = knn_blocks(n, block_rows)
    key_type = df.schema[key].dataType.simpleString()
    base = df.select(F.col(key).alias("id"), F.col(vec).alias("v"),
                     F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("blk"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    # By number: the tables are small beside their products, and would be put in a few tasks by size.
    q = base.select(F.col("blk").alias("qb"), every.alias("cb"), "id", "v").repartition(blocks * blocks, "qb", "cb")
    # Fresh attribute names on the candidate side: with the query side's names the
    # self-derived cogroup loses its value columns to column pruning.
    c = base.select(every.alias("qb"), F.col("blk").alias("cb"), F.col("id").alias("cid"),
                    F.col("v").alias("cv")).repartition(blocks * blocks, "qb", "cb")

    def block_topk(qt: pa.Table, ct: pa.Table) -> pa.Table:
        names, kind = ["id", "nid", "sim"], qt.schema.field("id").type if qt.num_columns else ct.schema.field("cid").type
        if not qt.num_rows or not ct.num_rows:
            return pa.table([pa.array([], kind), pa.array([], kind), pa.array([], pa.float64())], names)
        ct = ct.sort_by("cid")  # of equal similarities the first counts
        qid, cid = qt["id"].to_numpy(), ct["cid"].to_numpy()
        qv, cv = unit_rows(qt["v"]), unit_rows(ct["cv"])
        own = np.searchsorted(cid, qid), np.searchsorted(cid, qid, "right")
        single = cv.astype(np.float32)
        found = [(a + row, col, sim) for a in range(0, len(qv), KNN_STEP)
                 for row, col, sim in (nearest_columns(qv[a:a + KNN_STEP], cv, *(x[a:a + KNN_STEP] for x in own), k, single),)]
        row, col, sim = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table([qt["id"].take(pa.array(row)), ct["cid"].take(pa.array(col)), pa.array(sim)], names)

    part = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInArrow(
        block_topk, f"id {key_type}, nid {key_type}, sim double")
    best = top_n(part, ["id"], [F.desc(F.round("sim", 9)), F.col("nid")], k, "rank")
    return best.select(F.col("id").alias(key), "rank", F.col("nid").alias("neighbor_id"), "sim")


def knn_blocks(n: int, block_rows: int = KNN_ROWS) -> int:
    """Blocks of n rows; each row is sent twice as often."""
    return max(math.ceil(n / block_rows), min(KNN_BLOCKS, math.ceil(n / 256)), 1)


def unit_rows(vectors: pa.ChunkedArray) -> np.ndarray:
    """Unit rows of a column of equally long arrays."""
    v = np.concatenate([np.asarray(c.flatten(), np.float64) for c in vectors.chunks]).reshape(len(vectors), -1)
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)


def nearest_columns(q: np.ndarray, c: np.ndarray, first: np.ndarray, end: np.ndarray, k: int,
                    single: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, product) of the k greatest products of each row of ``q`` with rows of ``c``, but its own (``first`` to ``end``).

    Products count at 9 places, ties go to the smaller column.  Columns come in steps; a product in single
    floats (``single``: c in them), off by no more than ``off``, tells which of them can be above a row's k-th best so
    far, and those alone are multiplied in doubles.
    """
    row, col, sim = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    least = np.full(len(q), -np.inf)
    left, single = q.astype(np.float32), c.astype(np.float32) if single is None else single
    off = 2.0 ** -23 * (q.shape[1] + 4)  # rows are of unit length
    for b in range(0, len(c), KNN_WIDTH):
        s = left @ single[b:b + KNN_WIDTH].T
        for i in np.flatnonzero((end > np.maximum(first, b)) & (first < b + s.shape[1])).tolist():
            s[i, max(first[i] - b, 0):end[i] - b] = -np.inf
        # What only ties with the k-th best has a greater column and stays out; rounding moves a product by 5e-10.
        floor = least + 4e-10 - off
        if not b and s.shape[1] > k:
            floor = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] - 2e-9 - 2 * off
        at = np.flatnonzero(s >= np.nextafter(floor.astype(np.float32), np.float32(-np.inf))[:, None])
        r, x = np.divmod(at, s.shape[1])
        held = s[r, x] > -np.inf
        r, x = r[held], x[held]
        if not len(r):
            continue
        if len(r) > len(q) * s.shape[1] // 16:  # nearly all alike
            exact = (q @ c[b:b + KNN_WIDTH].T)[r, x]
        else:
            exact = np.concatenate([np.einsum("ij,ij->i", q[r[i:i + KNN_PAIRS]], c[b + x[i:i + KNN_PAIRS]]) for i in range(0, len(r), KNN_PAIRS)])
        row, col, sim = np.r_[row, r], np.r_[col, x + b], np.r_[sim, exact]
        order = np.lexsort((col, -np.round(sim, 9), row))
        row, col, sim = row[order], col[order], sim[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < k
        row, col, sim = row[keep], col[keep], sim[keep]
        ends, full = np.searchsorted(row, np.arange(len(q)), "right") - 1, np.bincount(row, minlength=len(q)) >= k
        least = np.where(full, np.round(sim[np.maximum(ends, 0)], 9), -np.inf)
    return row, col, sim


# ------------------------------------------------------------------ M6 / M7 / M10
def ward_merges(stats: pd.DataFrame) -> pd.DataFrame:
    """Weighted Ward over clusters (n, sum) via the nearest-neighbour chain.

    Returns merges sorted by height: (step, left, right, height, size); leaves are
    0..K-1, the cluster made at step i is K + i (the usual linkage-matrix numbering).
    """
    K = len(stats)
    if K < 2:
        return pd.DataFrame({"step": [], "left": [], "right": [], "height": [], "size": []})
    size = np.zeros(2 * K - 1)
    cent = np.zeros((2 * K - 1, len(stats["s"].iloc[0])))
    size[:K] = stats["n"].to_numpy(dtype=np.float64)
    cent[:K] = np.stack(stats["s"].to_numpy()) / size[:K, None]
    active = np.zeros(2 * K - 1, dtype=bool)
    active[:K] = True
    label = np.arange(2 * K - 1)

    def dist(a: int, others: np.ndarray) -> np.ndarray:
        na, nb = size[a], size[others]
        d = np.linalg.norm(cent[others] - cent[a], axis=1)
        return np.sqrt(2.0 * na * nb / (na + nb)) * d

    raw = []
    chain: list[int] = []
    nxt = K
    while nxt < 2 * K - 1:
        if not chain:
            chain.append(int(np.flatnonzero(active)[0]))
        a = chain[-1]
        cand = np.flatnonzero(active)
        cand = cand[cand != a]
        d = dist(a, cand)
        dmin = d.min()
        ties = cand[d == dmin]
        prev = chain[-2] if len(chain) > 1 else -1
        b = prev if prev in ties else int(ties.min())
        if b == prev:
            chain.pop()
            chain.pop()
            new = nxt
            nxt += 1
            size[new] = size[a] + size[b]
            cent[new] = (cent[a] * size[a] + cent[b] * size[b]) / size[new]
            active[a] = active[b] = False
            active[new] = True
            raw.append((min(a, b), max(a, b), float(dmin), int(size[new]), new))
        else:
            chain.append(b)
    # Order by height (stable) and renumber internal nodes in that order.
    order = sorted(range(len(raw)), key=lambda i: raw[i][2])
    renum = {raw[i][4]: K + j for j, i in enumerate(order)}
    rows = []
    for j, i in enumerate(order):
        l, r, h, s, _ = raw[i]
        l, r = renum.get(l, l), renum.get(r, r)
        rows.append((j, min(l, r), max(l, r), h, s))
    return pd.DataFrame(rows, columns=["step", "left", "right", "height", "size"])


def cut(merges: pd.DataFrame, n_leaves: int, k: int) -> np.ndarray:
    """M7: ``maxclust`` cut into at most k clusters; ids 1-based in order of first leaf.

    All merges up to the height of merge number n_leaves - k are applied, so tied
    heights can give fewer than k clusters, as in the original.
    """
    parent = list(range(2 * n_leaves - 1))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    n_apply = max(0, n_leaves - k)
    thr = merges["height"].iloc[n_apply - 1] if n_apply > 0 else -np.inf
    for row in merges.itertuples(index=False):
        if row.height > thr:
            break
        new = n_leaves + row.step
        parent[find(int(row.left))] = new
        parent[find(int(row.right))] = new
    roots = [find(i) for i in range(n_leaves)]
    ids: dict[int, int] = {}
    return np.array([ids.setdefault(r, len(ids) + 1) for r in roots], dtype=np.int32)


def last_merges(merges: DataFrame, p: int) -> DataFrame:
    """The last p merges (the top of the dendrogram)."""
    return merges.orderBy(F.desc("step")).limit(p)


# ------------------------------------------------------------------ M8 / A10
def ch_score(df: DataFrame, vec: str, cluster: str | Sequence[str]) -> DataFrame:
    """A10: Calinski-Harabasz per grouping, from grouped sums (no second pass).

    ``cluster`` may be [level, cluster]: the score is then computed per level.
    """
    keys = [cluster] if isinstance(cluster, str) else list(cluster)
    outer = keys[:-1]
    v = df.select(*keys, (array_to_vector(vec) if _is_array(df, vec) else F.col(vec)).alias("__v"))
    sq = F.aggregate(vector_to_array("__v"), F.lit(0.0), lambda a, x: a + x * x)
    per = v.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                               vector_to_array(Summarizer.sum(F.col("__v"))).alias("s"),
                               F.sum(sq).alias("ss"))
    s2 = F.aggregate("s", F.lit(0.0), lambda a, x: a + x * x)
    per = per.withColumn("__s2n", s2 / F.col("n"))
    tot_vec = v.groupBy(*outer).agg(vector_to_array(Summarizer.sum(F.col("__v"))).alias("S"))
    grp = per.groupBy(*outer).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"),
                                  F.sum("ss").alias("ss"), F.sum("__s2n").alias("s2n"))
    if not outer:  # one row each: join on a constant key
        grp, tot_vec, outer = grp.withColumn("__all", F.lit(0)), tot_vec.withColumn("__all", F.lit(0)), ["__all"]
    g = grp.join(tot_vec, outer)
    S2 = F.aggregate("S", F.lit(0.0), lambda a, x: a + x * x)
    B = F.col("s2n") - S2 / F.col("n")
    W = F.col("ss") - F.col("s2n")
    ch = F.when((F.col("k") > 1) & (W > 0), (B / (F.col("k") - 1)) / (W / (F.col("n") - F.col("k"))))
    return g.select(*[c for c in outer if c != "__all"], "k", "n", ch.alias("ch"))


def ch_from_stats(stats: pd.DataFrame, labels: np.ndarray) -> float:
    """CH of a labelling of clusters, from their (n, sum, sumsq)."""
    n = stats["n"].to_numpy(dtype=np.float64)
    s = np.stack(stats["s"].to_numpy())
    N, S = n.sum(), s.sum(axis=0)
    uniq = np.unique(labels)
    k = len(uniq)
    if k < 2 or k >= N:
        return float("nan")
    s2n = 0.0
    for u in uniq:
        m = labels == u
        sc = s[m].sum(axis=0)
        s2n += float(sc @ sc) / n[m].sum()
    B = s2n - float(S @ S) / N
    W = float(stats["ss"].sum()) - s2n
    return (B / (k - 1)) / (W / (N - k)) if W > 0 else float("nan")


def k_scores(stats: pd.DataFrame, merges: pd.DataFrame, ks: range) -> pd.DataFrame:
    """M8: (k, ch) for each k in ``ks``."""
    return pd.DataFrame({"k": list(ks), "ch": [ch_from_stats(stats, cut(merges, len(stats), k)) for k in ks]})


def chosen_k(scores: pd.DataFrame) -> int:
    """M8: the smallest k of the greatest score (of all, where no score is defined)."""
    ranked = scores.sort_values(["ch", "k"], ascending=[False, True], na_position="last")
    return int(ranked["k"].iloc[0])


# ------------------------------------------------------------------ M9
def centroids(df: DataFrame, vec: str, topic: str) -> DataFrame:
    """Per-topic mean vectors (a topic-sized table)."""
    v = df.select(topic, (array_to_vector(vec) if _is_array(df, vec) else F.col(vec)).alias("__v"))
    return v.groupBy(topic).agg(vector_to_array(Summarizer.mean(F.col("__v"))).alias("centroid"))


def assign_topics(df: DataFrame, key: str, vec: str, cents: pd.DataFrame, topic: str = "topic",
                  max_bytes: int = 256 << 20, block_cells: int = 1 << 22) -> DataFrame:
    """M9: nearest centroid (squared Euclidean, rounded to 9 places; ties -> smallest topic).

    ``cents`` (topic, centroid) is collected by the caller from a topic-sized table and
    shipped to the tasks with the function closure; its size in bytes is checked here.
    Distances come from products of blocks of rows with all centroids.
    """
    tids = cents[topic].to_numpy()
    cmat = np.stack(cents["centroid"].to_numpy()).astype(np.float64)
    if cmat.nbytes > max_bytes:
        raise ValueError("the centroids are too large to ship to every task")
    c2, step = (cmat ** 2).sum(axis=1), max(1, block_cells // len(cmat))
    key_type = df.schema[key].dataType.simpleString()
    t_type = "int" if np.issubdtype(tids.dtype, np.integer) else "string"

    def run(it):
        for pdf in it:
            if pdf.empty:
                continue
            x = np.stack(pdf[vec].to_numpy()).astype(np.float64)
            near = []
            for a in range(0, len(x), step):
                part = x[a:a + step]
                d = np.round((part ** 2).sum(axis=1)[:, None] + c2 - 2 * part @ cmat.T, 9)
                near.append(np.lexsort((np.broadcast_to(tids, d.shape), d), axis=-1)[:, 0])
            yield pd.DataFrame({key: pdf[key].to_numpy(), topic: tids[np.concatenate(near)]})
    return df.select(key, vec).mapInPandas(run, f"{key} {key_type}, {topic} {t_type}")
