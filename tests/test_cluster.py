"""Clustering operators against brute force: Ward (K = n), cuts, CH, kNN, nearest centroid."""

from __future__ import annotations

import pathlib

import numpy as np
import pandas as pd
import pytest

from tidemark.operators import cluster as C


def brute_ward(x: np.ndarray) -> list[tuple[frozenset, float]]:
    """Naive Ward: repeatedly merge the pair with the smallest Ward distance."""
    clusters = {i: (frozenset([i]), x[i].copy(), 1) for i in range(len(x))}
    out = []
    nxt = len(x)
    while len(clusters) > 1:
        best = None
        keys = sorted(clusters)
        for a_i, a in enumerate(keys):
            for b in keys[a_i + 1:]:
                _, ca, na = clusters[a]
                _, cb, nb = clusters[b]
                d = np.sqrt(2.0 * na * nb / (na + nb)) * np.linalg.norm(ca - cb)
                if best is None or d < best[0]:
                    best = (d, a, b)
        d, a, b = best
        ma, ca, na = clusters.pop(a)
        mb, cb, nb = clusters.pop(b)
        clusters[nxt] = (ma | mb, (ca * na + cb * nb) / (na + nb), na + nb)
        out.append((ma | mb, d))
        nxt += 1
    return out


def partition(labels) -> set[frozenset]:
    groups: dict = {}
    for i, lab in enumerate(labels):
        groups.setdefault(lab, set()).add(i)
    return {frozenset(g) for g in groups.values()}


def brute_cut(n: int, merges: list[tuple[frozenset, float]], k: int) -> set[frozenset]:
    parts = {frozenset([i]) for i in range(n)}
    for members, _ in sorted(merges, key=lambda m: m[1])[: n - k]:
        parts = {p for p in parts if not p <= members} | {members}
    return parts


def stats_of(x: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"micro": np.arange(len(x)), "n": np.ones(len(x), dtype=np.int64),
                         "s": list(x), "ss": (x * x).sum(axis=1)})


def test_ward_equals_brute_force():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.3, size=(12, 3)) for c in (0.0, 2.0, 5.0)])
    merges = C.ward_merges(stats_of(x))
    ref = brute_ward(x)
    assert np.allclose(np.sort(merges["height"].to_numpy()), np.sort([d for _, d in ref]))
    assert (np.diff(merges["height"].to_numpy()) >= 0).all()
    for k in (1, 2, 3, 5, 10, 36):
        assert partition(C.cut(merges, len(x), k)) == brute_cut(len(x), ref, k), k


def test_cuts_nest_and_ids_are_one_based():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 4))
    merges = C.ward_merges(stats_of(x))
    med, fine = C.cut(merges, 200, 25), C.cut(merges, 200, 60)
    assert med.min() == 1 and med.max() == 25 and fine.max() == 60
    for f in np.unique(fine):
        assert len(np.unique(med[fine == f])) == 1


def test_weighted_ward_merges_groups():
    # Two clusters of one tight group join before any cross-group merge.
    stats = pd.DataFrame({"micro": [0, 1, 2], "n": [10, 10, 1],
                          "s": [np.array([0.0, 0.0]) * 10, np.array([0.1, 0.0]) * 10,
                                np.array([5.0, 5.0])], "ss": [0.0, 0.1, 50.0]})
    merges = C.ward_merges(stats)
    assert (merges.iloc[0]["left"], merges.iloc[0]["right"]) == (0, 1)
    assert merges.iloc[-1]["size"] == 21


def direct_ch(x: np.ndarray, labels: np.ndarray) -> float:
    mean = x.mean(axis=0)
    ks = np.unique(labels)
    b = sum((labels == k).sum() * np.sum((x[labels == k].mean(axis=0) - mean) ** 2) for k in ks)
    w = sum(np.sum((x[labels == k] - x[labels == k].mean(axis=0)) ** 2) for k in ks)
    return (b / (len(ks) - 1)) / (w / (len(x) - len(ks)))


def test_ch_score_equals_direct(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 6))
    lab = rng.integers(0, 5, size=120)
    df = spark.createDataFrame([(int(l), v.tolist()) for l, v in zip(lab, x)], "c int, v array<double>")
    got = C.ch_score(df, "v", "c").first()
    assert got["k"] == 5 and got["n"] == 120
    assert got["ch"] == pytest.approx(direct_ch(x, lab), rel=1e-9)
    assert C.ch_from_stats(stats_of(x), lab) == pytest.approx(direct_ch(x, lab), rel=1e-9)


def test_best_k_first_strict_maximum():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 0.1, size=(15, 2)) for c in range(4)])
    stats = stats_of(x)
    merges = C.ward_merges(stats)
    scores = C.k_scores(stats, merges, range(2, 8))
    assert C.chosen_k(scores) == 2 + int(np.argmax(scores["ch"])) == 4
    tied = pd.DataFrame({"k": [2, 3, 4], "ch": [float("nan"), 5.0, 5.0]})
    assert C.chosen_k(tied) == 3


def test_knn_graph_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(150, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<float>")
    got = C.knn_graph(df, "id", "v", k=5, block_rows=40).toPandas()
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    sim = u @ u.T
    np.fill_diagonal(sim, -np.inf)
    for i in range(len(x)):
        exp = list(np.lexsort((np.arange(len(x)), -np.round(sim[i], 9)))[:5])
        g = got[got["id"] == i].sort_values("rank")
        assert list(g["neighbor_id"]) == exp and list(g["rank"]) == [1, 2, 3, 4, 5]


def test_assign_topics_nearest_centroid(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(60, 3))
    cents = pd.DataFrame({"topic": [0, 1, 2], "centroid": [np.zeros(3), np.ones(3), -np.ones(3)]})
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = C.assign_topics(df, "id", "v", cents).toPandas().sort_values("id")
    d = ((x[:, None, :] - np.stack(cents["centroid"])[None]) ** 2).sum(axis=2)
    assert list(got["topic"]) == list(d.argmin(axis=1))


def test_embed_is_unit_length_and_cached(spark, scratch):
    df = spark.createDataFrame([(1, "alpha beta gamma"), (2, "台積電 漲停"), (3, "alpha beta gamma")],
                               "doc_id long, text string")
    e = C.embed(df, dim=64).toPandas()
    norms = [float(np.linalg.norm(v)) for v in e["embedding"]]
    assert np.allclose(norms, 1.0, atol=1e-6)
    path = f"{scratch}/cache"
    first = C.embed_cached(spark, df, path, "hash64", dim=64)
    assert first.count() == 3
    # A second call encodes nothing new: the cache keeps two distinct texts.
    C.embed_cached(spark, df, path, "hash64", dim=64).count()
    assert spark.read.parquet(path).count() == 2
    # A hash that two jobs appended is read once.
    spark.read.parquet(path).write.parquet(f"{scratch}/copy")
    spark.read.parquet(f"{scratch}/copy").write.mode("append").parquet(path)
    again = C.embed_cached(spark, df, path, "hash64", dim=64)
    assert sorted(r["doc_id"] for r in again.collect()) == [1, 2, 3]
    assert spark.read.parquet(path).count() == 4


def test_cache_that_cannot_be_read_is_no_missing_cache(spark, scratch):
    df = spark.createDataFrame([(1, "alpha beta")], "doc_id long, text string")
    (pathlib.Path(scratch) / "broken").mkdir(parents=True)
    (pathlib.Path(scratch) / "broken" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        C.embed_cached(spark, df, f"{scratch}/broken", "hash64", dim=64).count()


def test_named_embedding_cache_is_used(spark, scratch):
    before = C.cache_folder(spark)
    assert before != C.cache_folder(spark)
    spark.conf.set(C.CACHE_SETTING, f"{scratch}/kept")
    try:
        assert C.cache_folder(spark) == C.cache_folder(spark) == f"{scratch}/kept"
    finally:
        spark.conf.unset(C.CACHE_SETTING)


def test_reduce_pca_dims(spark):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(i, rng.normal(size=10).tolist()) for i in range(50)], "id long, v array<double>")
    out = C.reduce(df, "v", 3)
    assert out.count() == 50
    assert len(out.first()["reduced"]) == 3


def test_strips_of_a_block_give_the_nearest_with_ties_to_the_smaller_id():
    rng = np.random.default_rng(5)
    c = rng.integers(-2, 3, size=(9000, 3)).astype(float) + [[0.1, 0.2, 0.3]]  # 125 different rows: ties everywhere
    c /= np.linalg.norm(c, axis=1, keepdims=True)
    q, own = c[100:140], np.arange(100, 140)
    row, col, sim = C.nearest_columns(q, c, own, own + 1, 7)
    full = q @ c.T
    full[np.arange(40), own] = -np.inf
    for i in range(40):
        want = np.lexsort((np.arange(9000), -np.round(full[i], 9)))[:7]
        assert col[row == i].tolist() == want.tolist()
        assert np.allclose(sim[row == i], full[i, want])


def test_a_row_is_sent_to_few_blocks(spark):
    """F8: at 256 rows a block each row of 100,000 was sent 800 times."""
    assert C.knn_blocks(100_000) <= 6 and C.knn_blocks(600_000) <= 10 and C.knn_blocks(0) == 1
    df = spark.range(3000).selectExpr("id", "array(cast(id as float), cast(1 as float)) AS v")
    plan = C.knn_graph(df, "id", "v", 3)._jdf.queryExecution().toString()
    assert f"Some({C.KNN_BLOCKS - 1})" in plan or f"sequence(0, {C.KNN_BLOCKS - 1}" in plan or "[0,1,2,3,4,5]" in plan


def test_few_pairs_are_multiplied_in_doubles(monkeypatch):
    """F4 of round 4: every product of the exact graph was made in doubles."""
    rng, real, pairs = np.random.default_rng(5), np.einsum, []
    monkeypatch.setattr(C.np, "einsum", lambda how, a, b: pairs.append(len(a)) or real(how, a, b))
    for n, dims, spread in ((9000, 16, 1.0), (3000, 16, 1e-8)):  # all apart; nearly all alike
        x = rng.normal(size=(4, dims))[rng.integers(0, 4, n)] + rng.normal(size=(n, dims)) * spread
        x[100:140] = x[7]
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        at, pairs[:] = np.arange(60, 160), []
        row, col, sim = C.nearest_columns(x[at], x, at, at + 1, 12)
        s = x[at] @ x.T
        s[np.arange(100), at] = -np.inf
        want = np.lexsort((np.broadcast_to(np.arange(n), s.shape), -np.round(s, 9)), axis=-1)[:, :12]
        assert (col.reshape(100, 12) == want).all() and np.allclose(sim, s[row, col], rtol=0, atol=1e-12)
        assert spread < 1 or 1200 <= sum(pairs) < 0.02 * s.size
