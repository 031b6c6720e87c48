"""Hard negatives against all products, the cover tree's own rules, and edge cases."""

from __future__ import annotations

import math

import duckdb
import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import negatives


def plain(rows):
    """The contract's rows from all products of (vec_id, embedding, label)."""
    best = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [max(-(1 << 26), min(1 << 26, math.floor(256 * x))) for x in v]
        label = (label + 1) % 10 if i % 7 == 0 else label
        best[i] = min(best.get(i, (label, w)), (label, w))
    out = []
    for a, (label, v) in best.items():
        if a % 100:
            continue
        score = {i: sum(x * y for x, y in zip(v, w, strict=False)) for i, (_, w) in best.items()}
        by = sorted((i for i in best if i != a), key=lambda i: (-score[i], i))
        for p in [i for i in by if best[i][0] == label][:5]:
            near = [i for i in by if best[i][0] != label and 80 * score[p] <= 100 * score[i] <= 100 * score[p]][:5]
            out += [(a, p, k, i, score[p], score[i]) for k, i in enumerate(near, 1)]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def got(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_negatives_equal_sql_and_plain(spark):
    path = "/root/testdata/sf0.01/embeddings.parquet"
    df = spark.read.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    r = con.execute(negatives.ORACLE_SQL)
    assert [c[0] for c in r.description] == COLUMNS
    want = sorted(r.fetchall())
    assert got(negatives.hard_negatives(df)) == want == plain([(x["vec_id"], x["embedding"], x["label"]) for x in df.collect()])


def clustered(seed, n, dim, spread=0.05):
    """Rows near a few centres with many exact copies, so that trees have depth and hot leaves."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(12, dim))
    v = centre[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, dim))
    v[rng.random(n) < 0.3] = centre[0]
    return [(int(i), [float(x) for x in v[i]], int(rng.integers(0, 4))) for i in range(n)]


def test_negatives_of_clusters_and_copies_over_many_trees(spark):
    rows = clustered(1, 900, 5)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    r = negatives.scaled_rows(df)
    anchors = r.filter("id % 100 = 0")
    want = plain([(x["vec_id"], x["embedding"], x["label"]) for x in df.collect()])
    assert want and got(negatives.mine(r, anchors, tree_rows=60, block=3)) == want
    assert got(negatives.hard_negatives(df)) == want


def test_cover_tree_rules_and_pruning():
    rng = np.random.default_rng(2)
    vectors = np.floor(256 * np.asarray([v for _, v, _ in clustered(3, 1500, 4, 0.02)]))
    ids, labels = np.arange(len(vectors)), rng.integers(0, 3, len(vectors)).astype(np.int32)
    tree = negatives.CoverTree(4, negatives.CoverTree.build(ids, labels, vectors, 6))
    n = len(tree.radius)
    parent = np.zeros(n, int)
    for i in range(n):
        parent[tree.first[i]:tree.first[i + 1]] = i
    assert sorted(np.concatenate([np.arange(tree.first[i], tree.first[i + 1]) for i in range(n)]).tolist()) == list(range(1, n))  # one parent each
    square = (tree.points ** 2).sum(axis=1)
    lifted = np.c_[tree.points, np.sqrt(square.max() - square)]
    for i in range(n):  # everything below lies within the radius
        up = i
        while up:
            up = parent[up]
            assert np.linalg.norm(lifted[i] - lifted[up]) <= tree.radius[up] + 1e-6
    hung, level = negatives._hang(lifted)
    for at in np.unique(level):  # nets: apart from each other, and covering what is below
        net = lifted[level >= at]
        gap = np.linalg.norm(net[:, None] - net[None], axis=2) + np.where(np.eye(len(net)), 1e18, 0)
        assert gap.min() > negatives.BASE ** at - 1e-6 or at == level.max()
    taken = []
    plain_products = negatives.products
    try:
        negatives.products = lambda m, q, exact: taken.append(len(m)) or plain_products(m, q, exact)
        first = negatives._First(-(1 << 62), 1 << 62, 5)
        tree.search(tree.points[7], True, 1, True, -1, [first])
    finally:
        negatives.products = plain_products
    score = vectors @ tree.points[7]
    want = sorted(np.flatnonzero(labels == 1).tolist(), key=lambda i: (-score[i], i))[:5]
    assert first.ids.tolist() == want
    assert sum(taken) < n / 2  # whole groups are skipped


def test_negative_edges(spark):
    rows = clustered(4, 60, 3)
    inf, nan = float("inf"), float("nan")
    rows += [(100, None, 1), (200, [1.0, None, 2.0], 1), (300, [1.0, nan, 0.0], 2), (400, [inf, 0.0, 0.0], 2), (500, [1.0, 2.0, 3.0], None), (None, [1.0, 1.0, 1.0], 1),
             (600, [1.0, 2.0], 1), (601, [], 2), (700, [3e38, -3e38, 1.0], 1), (800, [0.0, 0.0, 0.0], 1), (900, [-1.0, -1.0, -1.0], 0), *rows[:5],
             (3, [9.0, 9.0, 9.0], 0), (-100, [0.5, 0.5, 0.5], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("id", F.lit(1)).withColumn("tree", F.lit("x"))
    assert got(negatives.hard_negatives(df)) == plain([(x["vec_id"], x["embedding"], x["label"]) for x in df.collect()])
    for few in (df.filter("vec_id = 300"), df.filter("vec_id < -500"), df.filter("vec_id = 0")):
        assert negatives.hard_negatives(few).count() == 0
