"""Hard negatives by exact windows of inner products, searched in cover trees.

An anchor's positives are the nearest other rows of its label; its hard negatives for a
positive are the nearest rows of other labels whose score lies in a window below the
positive's.  Both are searches for the first k rows within windows of the inner product.

A norm-augmented row ``(x, sqrt(M^2 - |x|^2))`` has the length M of the longest row, so that
distances order like inner products, also for rows of different lengths.  The rows are
dealt over trees of about ``TREE_ROWS`` rows by their hash.  A tree is a cover tree: its
levels are nets of the greedy (farthest first) order with radii that fall by ``BASE``, a row
of one level hangs under its nearest row of the levels above, and each row knows the
covering radius of what is under it.  With the score s of a row, everything under it
has scores within s plus or minus |anchor| times that radius.  The search takes the rows of
the highest bounds first, leaves out those that lie outside all windows or below the k-th
best of each, and takes the exact integer score of every row that it reaches.  Trees of
one group are searched one after another, so the k-th best of one prunes the next.

Anchors in blocks meet groups of trees, each pair in a task; a task returns k rows an anchor
and window, which Spark merges.  Equal vectors of a tree are one point; of them and one label
the first ``k + 1`` ids suffice, as ties go to the smaller id and only the anchor itself is
left out, so copies cost nothing and no result is lost.

Edge cases: rows with a null label or vector, or a component that is null or not finite,
take no part, nor do rows without an id, which no result could name; of rows that share
an id the first by label and vector takes part; shorter vectors count as filled up with
zeros; components beyond 2^26 after scaling count as 2^26, so scores fit a long; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Positives of an anchor, and negatives of a positive.
POSITIVES, NEGATIVES = 5, 5
#: Window of the negatives, in hundredths of the positive's score.
LOW, HIGH = 80, 100
#: Rows of a tree, trees of a group, anchors of a block (all about).
TREE_ROWS, GROUP, ANCHORS = 2048, 4, 2048
#: Factor between the radii of two levels.
BASE = 2.0
#: Largest component, so that 512 products fit a long.
_LARGEST = 1 << 26
#: Rows of the frontier that are opened at once, doubled with each step.
_OPENED = 4


def scaled_rows(embeddings: DataFrame) -> DataFrame:
    """(id, label, v): valid rows with floored components and the contract's labels."""
    x = F.transform("embedding", lambda c: F.floor(F.lit(256) * c.cast("double")))
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("int")
    held = F.transform(x, lambda c: F.greatest(F.lit(-_LARGEST), F.least(F.lit(_LARGEST), c)).cast("int"))
    one = rows.select(F.col("vec_id").cast("long").alias("id"), F.struct(label.alias("label"), held.alias("v")).alias("r"))
    return one.groupBy("id").agg(F.min("r").alias("r")).select("id", "r.label", "r.v")


def _matrix(vectors, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def products(m: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; floats hold them while no partial sum can pass 2^53."""
    return (m @ q).astype(np.int64) if exact else m.astype(np.int64) @ q.astype(np.int64)


class CoverTree:
    """A cover tree over distinct integer vectors; the children of a point are neighbours in order.

    ``first[i]:first[i + 1]`` are the children of point i, ``radius[i]`` covers all under it,
    ``starts[i]:starts[i + 1]`` are its ids and labels.
    """

    FIELDS = {"points": np.int32, "first": np.int64, "radius": np.float64, "starts": np.int64, "ids": np.int64, "labels": np.int32}

    def __init__(self, dim: int, arrays: dict[str, bytes]):
        for name, kind in self.FIELDS.items():
            setattr(self, name, np.frombuffer(arrays[name], kind))
        self.points = self.points.reshape(len(self.radius), dim).astype(np.float64)

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, keep: int) -> dict[str, bytes]:
        """The arrays of the tree over these rows, of equal vector and label the first ``keep``."""
        points, point = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, labels, point.ravel()))
        ids, labels, point = ids[order], labels[order], point.ravel()[order]
        few = pd.Series(ids).groupby([point, labels]).cumcount().to_numpy() < keep
        ids, labels, point = ids[few], labels[few], point[few]
        square = (points * points).sum(axis=1)
        lifted = np.c_[points, np.sqrt(square.max() - square)]
        parent, level = _hang(lifted)
        # Breadth first, so that children lie together.
        depth = np.zeros(len(points), np.int64)
        for i in np.argsort(-level, kind="stable")[1:].tolist():
            depth[i] = depth[parent[i]] + 1
        rank = np.zeros(len(points), np.int64)
        back = np.zeros(0, np.int64)
        for d in range(int(depth.max()) + 1):
            at = np.flatnonzero(depth == d)
            at = at[np.argsort(rank[parent[at]], kind="stable")]
            rank[at] = len(back) + np.arange(len(at))
            back = np.r_[back, at]
        parent, lifted = rank[parent[back]], lifted[back]
        radius = np.zeros(len(back))
        low, up = np.arange(len(back)), parent
        while len(low):  # each point widens all above it
            np.maximum.at(radius, up, np.sqrt(((lifted[low] - lifted[up]) ** 2).sum(axis=1)))
            on = up > 0
            low, up = low[on], parent[up[on]]
        own = rank[point]
        order = np.lexsort((ids, own))
        made = {"points": points[back], "first": np.r_[np.searchsorted(parent[1:], np.arange(len(back)), "left") + 1, len(back)], "radius": radius,
                "starts": np.searchsorted(own[order], np.arange(len(back) + 1), "left"), "ids": ids[order], "labels": labels[order]}
        return {name: np.ascontiguousarray(made[name], kind).tobytes() for name, kind in cls.FIELDS.items()}

    def search(self, q: np.ndarray, exact: bool, label: int, same: bool, own: int, found: list) -> None:
        """Offer rows to the windows in ``found``, the highest bounds first."""
        length = float(np.sqrt(q @ q)) * (1 + 1e-9)
        nodes = np.zeros(1, np.int64)
        opened = _OPENED
        scores = products(self.points[:1], q, exact)
        while True:
            self._offer(nodes, scores, label, same, own, found)
            reach = length * self.radius[nodes] + 0.5
            has = self.radius[nodes] > 0
            if opened == _OPENED:
                front, high, low = nodes[has], (scores + reach)[has], (scores - reach)[has]
            else:
                front, high, low = np.r_[front, nodes[has]], np.r_[high, (scores + reach)[has]], np.r_[low, (scores - reach)[has]]
            useful = np.zeros(len(front), bool)
            for w in found:
                useful |= (high >= w.least()) & (low <= w.high)
            front, high, low = front[useful], high[useful], low[useful]
            if not len(front):
                return
            best = np.argsort(-high, kind="stable")
            now, rest = front[best[:opened]], best[opened:]
            front, high, low = front[rest], high[rest], low[rest]
            sizes = self.first[now + 1] - self.first[now]
            nodes = np.repeat(self.first[now] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
            # The children of one point are a slice, which needs no copy.
            scores = products(self.points[nodes] if len(now) > 1 else self.points[nodes[0]:nodes[-1] + 1], q, exact)
            opened *= 2

    def _offer(self, nodes: np.ndarray, scores: np.ndarray, label: int, same: bool, own: int, found: list) -> None:
        lowest, highest = min(w.least() for w in found), max(w.high for w in found)
        near = (scores >= lowest) & (scores <= highest)
        nodes, scores = nodes[near], scores[near]
        if not len(nodes):
            return
        sizes = self.starts[nodes + 1] - self.starts[nodes]
        rows = np.repeat(self.starts[nodes] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        ids, scores = self.ids[rows], np.repeat(scores, sizes)
        right = ((self.labels[rows] == label) == same) & (ids != own)
        for w in found:
            w.add(ids[right], scores[right])


def _hang(lifted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent and level of each point: nets of the greedy order with radii BASE ** level."""
    n = len(lifted)
    square = (lifted * lifted).sum(axis=1)

    def to(i: int) -> np.ndarray:
        return np.maximum(square + square[i] - 2.0 * (lifted @ lifted[i]), 0.0)

    near = to(0)
    top = np.sqrt(near.max()) if n > 1 else 1.0
    level = np.zeros(n, np.int64)
    level[0] = int(np.ceil(np.log(max(top, 1e-9)) / np.log(BASE))) + 1
    parent, gap = np.zeros(n, np.int64), near.copy()  # nearest point of the levels above, so far
    here: list[int] = []
    now = None
    placed = np.zeros(n, bool)
    placed[0] = True

    def merge() -> None:
        """The points of the level just ended may be parents of what follows."""
        if here:
            d = square[:, None] + square[here] - 2.0 * (lifted @ lifted[here].T)
            best = d.argmin(axis=1)
            d = d[np.arange(n), best]
            better = (d < gap) & ~placed
            gap[better], parent[better] = d[better], np.asarray(here)[best[better]]
            here.clear()

    for _ in range(n - 1):
        i = int(np.where(placed, -1.0, near).argmax())
        at = int(np.ceil(np.log(max(np.sqrt(near[i]), 1e-9)) / np.log(BASE))) - 1  # near > BASE ** at
        if at != now:
            merge()
            now = at
        level[i], placed[i] = at, True
        here.append(i)
        near = np.minimum(near, to(i))
    return parent, level


class _First:
    """The first k rows of a window, by score and then id."""

    def __init__(self, low: int, high: int, k: int):
        self.low, self.high, self.k = low, high, k
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> int:
        """A row below this score is of no use."""
        return max(self.low, int(self.scores[-1])) if len(self.ids) == self.k else self.low

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        use = (scores >= self.least()) & (scores <= self.high)
        if use.any():
            ids, scores = np.r_[self.ids, ids[use]], np.r_[self.scores, scores[use]]
            order = np.lexsort((ids, -scores))[:self.k]
            self.ids, self.scores = ids[order], scores[order]


def index(rows: DataFrame, keep: int = 1 + max(POSITIVES, NEGATIVES), tree_rows: int = TREE_ROWS) -> tuple[DataFrame, int]:
    """(grp, dim, arrays of a cover tree) with every row in one tree, and the number of groups."""
    trees = max(1, -(-rows.count() // tree_rows))

    def build(df: pd.DataFrame) -> pd.DataFrame:
        dim = max(len(x) for x in df["v"])
        made = CoverTree.build(df["id"].to_numpy(np.int64), df["label"].to_numpy(np.int32), _matrix(df["v"].tolist(), dim), keep)
        return pd.DataFrame({"grp": [int(df["tree"].iloc[0]) // GROUP], "dim": [dim], **{k: [v] for k, v in made.items()}})

    dealt = rows.withColumn("tree", F.pmod(F.xxhash64("id"), F.lit(trees)).cast("int"))
    schema = "grp int, dim int, " + ", ".join(f"{k} binary" for k in CoverTree.FIELDS)
    return staged(dealt.groupBy("tree").applyInPandas(build, schema), "negatives-index"), -(-trees // GROUP)


def search(trees: DataFrame, groups: int, asked: DataFrame, same: bool, k: int, block: int = ANCHORS) -> DataFrame:
    """(anchor_id, place, id, score): the first ``k`` rows in each window of each anchor, by group of trees.

    ``asked``: (anchor_id, label, v, windows), windows an array of (low, high) scores, of which
    ``place`` is the position; ``same`` asks for rows of the anchor's label, else for others.
    """
    blocks = max(1, -(-asked.count() // block))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    queries = asked.select(F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)).cast("int").alias("blk"), every(groups).alias("grp"), "anchor_id", "label", "v", "windows")
    sent = trees.select(every(blocks).alias("b"), F.col("grp").alias("g"), "dim", *CoverTree.FIELDS)

    def run(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        found = [[_First(w["low"], w["high"], k) for w in x] for x in q["windows"]]
        for row in t.to_dict("records"):
            tree = CoverTree(row["dim"], row)
            dim = max([row["dim"], *map(len, q["v"])])
            tree.points = np.pad(tree.points, ((0, 0), (0, dim - row["dim"])))
            longest = float(np.sqrt((tree.points ** 2).sum(axis=1).max()))
            for a, label, v, f in zip(q["anchor_id"].tolist(), q["label"].tolist(), _matrix(q["v"].tolist(), dim), found, strict=True):
                tree.search(v, longest * float(np.sqrt(v @ v)) < 2 ** 52, label, same, a, f)
        for a, f in zip(q["anchor_id"].tolist(), found, strict=True):
            out += [(a, place, i, s) for place, w in enumerate(f) for i, s in zip(w.ids.tolist(), w.scores.tolist(), strict=True)]
        return pd.DataFrame(out, columns=["anchor_id", "place", "id", "score"])

    return queries.groupBy("blk", "grp").cogroup(sent.groupBy("b", "g")).applyInPandas(run, "anchor_id long, place int, id long, score long")


def mine(rows: DataFrame, anchors: DataFrame, tree_rows: int = TREE_ROWS, block: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` and ``anchors``: (id, label, v), ids apart, as ``scaled_rows`` gives them.
    """
    trees, groups = index(rows, tree_rows=tree_rows)
    asked = anchors.select(F.col("id").alias("anchor_id"), "label", "v")
    best = Window.orderBy(F.desc("score"), "id")
    anywhere = F.array(F.struct(F.lit(-(1 << 62)).alias("low"), F.lit(1 << 62).alias("high")))
    near = search(trees, groups, asked.withColumn("windows", anywhere), True, POSITIVES, block)
    top = near.withColumn("n", F.row_number().over(best.partitionBy("anchor_id"))).filter(F.col("n") <= POSITIVES)
    positives = staged(top.select("anchor_id", (F.col("n") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    score = F.col("positive_score")
    window = F.struct((-F.floor(-score * LOW / 100)).cast("long").alias("low"), F.floor(score * HIGH / 100).cast("long").alias("high"))
    windows = positives.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", window.alias("w")))).alias("w"))  # POSITIVES at most
    asked = asked.join(windows.select("anchor_id", F.transform("w", lambda x: x["w"]).alias("windows")), "anchor_id")
    found = search(trees, groups, asked, False, NEGATIVES, block).join(positives, ["anchor_id", "place"])
    ranked = found.withColumn("rank", F.row_number().over(best.partitionBy("anchor_id", "positive_id"))).filter(F.col("rank") <= NEGATIVES)
    return ranked.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """The contract's rows: anchors are the rows whose vec_id is divisible by 100."""
    rows = staged(scaled_rows(embeddings), "negatives-rows")
    return mine(rows, rows.filter(F.col("id") % 100 == 0))


ORACLE_SQL = f"""
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
           FROM r a JOIN r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
     p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
     n AS (SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
                  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
           FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
           WHERE {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}
"""
