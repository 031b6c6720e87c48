"""Benchmark decontamination by spaced-seed hashing.

Fixed masks over runs of words skip some positions, so a hash of a mask's kept words also
meets where a skipped word was replaced.  The hashes of the benchmark texts and of all
windows of the documents are joined; around each hit the two texts are laid side by side
and the longest stretch with a share of ``MIN_EQUAL`` equal words must hold enough of them.
The four masks together meet every stretch of 15 words with up to two replaced words, and
of those at the two limits, 15 words with 3 replaced, 0.95 of all placements and more.

The benchmark goes to the tasks in blocks of bounded size (``BLOCK_WORDS``), one pass over
the documents for each block: one block as a rule, more for very large benchmarks, never a
cut.

Words are lower-cased (A-Z) and lose common punctuation, on both sides.

Edge cases: null or empty texts on either side meet nothing; benchmark texts under
``MIN_ITEM`` words cannot be told from chance and are not searched; copies of a benchmark
text are searched once and all reported; repeated documents are searched row by row and
reported once for each item; rows without a doc_id give pairs with a null doc_id; other
columns are not read.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, kept, row_key, staged, tidy

#: Masks of six kept words each.
MASKS = ("111111", "1011111", "110001111", "11110101")
#: A match has this many equal words (or the whole of a shorter item) ...
MIN_MATCH = 12
#: ... and this share of equal words between its ends.
MIN_EQUAL = 0.8
#: A stretch has that share if its equal words at one each pay for its replaced words at this.
REPLACED = 4.0
MIN_ITEM = 6
#: Words of benchmark texts that one block holds.
BLOCK_WORDS = 2_000_000
#: Words of documents that are hashed at once.
BATCH_WORDS = 1_000_000
_MARKS = b".,;:!?\"'()[]"
_KEPT = [np.asarray([i for i, c in enumerate(m) if c == "1"]) for m in MASKS]

SCHEMA = "doc_id long, item_id long, matched int, replaced int, doc_word long, item_word int, item_words int"


def words(raw: bytes | None) -> list[bytes]:
    return raw.lower().translate(None, _MARKS).split() if raw else []


class Index:
    """The masked hashes of a block of benchmark texts."""

    def __init__(self, items: list[tuple[int, bytes]]):
        groups = defaultdict(list)
        for item, raw in items:
            if len(w := tuple(words(raw))) >= MIN_ITEM:
                groups[w].append(item)
        self.items = [sorted(x) for x in groups.values()]
        self.number: dict[bytes, int] = {}
        flat = [self.number.setdefault(w, len(self.number)) for g in groups for w in g]
        self.sizes = np.asarray([len(g) for g in groups], np.int64)
        # A blank of -2 between texts, which equals no word and not the -1 of unknown words.
        self.flat = np.full(len(flat) + len(self.sizes) + 1, -2, np.int64)
        self.start = np.cumsum(self.sizes + 1) - self.sizes
        self.of = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.flat[np.arange(len(flat)) + self.of + 1] = flat
        self.masked = []
        for kept in _KEPT:
            at, h = self.hashes(self.flat, kept)
            order = np.argsort(h, kind="stable")
            self.masked.append((h[order], at[order]))

    @staticmethod
    def hashes(flat: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window start, hash) of the windows whose kept words are all known."""
        n = len(flat) - int(kept[-1])
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(flat[:n] >= 0)
        for k in kept[1:]:
            at = at[flat[at + k] >= 0]
        h = np.zeros(len(at), np.uint64)
        for k in kept:
            h = (h ^ flat[at + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return at, h

    def hits(self, flat: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(position in ``flat``, position in the block) of windows with equal hashes."""
        for kept, (held, where) in zip(_KEPT, self.masked, strict=True):
            at, h = self.hashes(flat, kept)
            lo, hi = np.searchsorted(held, h), np.searchsorted(held, h, side="right")
            met = np.flatnonzero(hi > lo)
            n = (hi - lo)[met]
            # In parts, so that words that many texts share do not grow one array without bound.
            cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(n) // BATCH_WORDS)) + 1).tolist(), len(met)]
            for a, z in zip(cuts, cuts[1:], strict=False):
                m, c = met[a:z], n[a:z]
                if len(m):
                    offset = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
                    yield np.repeat(at[m], c), where[np.repeat(lo[m], c) + offset]

    def matches(self, flat: np.ndarray, doc_of: np.ndarray, doc_start: np.ndarray) -> Iterator[tuple]:
        """(document, item, matched, replaced, first word there, first word here, item's words)."""
        seen: set[tuple[int, int, int]] = set()
        best: dict[tuple[int, int], tuple] = {}
        for p, q in self.hits(flat):
            item = np.searchsorted(self.start, q, side="right") - 1
            lay = p - (q - self.start[item])  # where the item's first word would be
            for d, i, first in np.unique(np.stack([doc_of[p], item, lay], axis=1), axis=0).tolist():
                if (d, i, first) not in seen:
                    seen.add((d, i, first))
                    found = self._verify(flat[doc_start[d]:doc_start[d + 1] - 1], i, first - int(doc_start[d]))
                    if found and found[0] > best.get((d, i), (0,))[0]:
                        best[d, i] = (*found[:2], first - int(doc_start[d]) + found[2], found[2])
        for (d, i), found in best.items():
            for item in self.items[i]:
                yield d, item, *found, int(self.sizes[i])

    def _verify(self, flat: np.ndarray, i: int, first: int) -> tuple[int, int, int] | None:
        """(matched, replaced, item word) of the stretch with most equal words among those equal enough, if they are enough.

        From each first equal word the last end with a sum of no less than there is looked up
        in the largest sums that any later end reaches.
        """
        size = int(self.sizes[i])
        a, z = max(0, -first), min(size, len(flat) - first)
        equal = flat[first + a:first + z] == self.flat[self.start[i] + a:self.start[i] + z]
        least = min(MIN_MATCH, size)
        begin = np.flatnonzero(equal)
        if len(begin) < least:
            return None
        total = np.r_[0.0, np.cumsum(np.where(equal, 1.0, -REPLACED))]
        later = np.maximum.accumulate(total[::-1])  # from the last end backwards, rising
        end = len(equal) - np.searchsorted(later, total[begin])
        count = np.r_[0, np.cumsum(equal)]
        matched = count[end] - count[begin]
        last = begin[count[end] - 1]  # replaced words behind it are left out
        replaced = last + 1 - begin - matched
        best = np.lexsort((begin, replaced, -matched))[0]
        if matched[best] < least:
            return None
        return int(matched[best]), int(replaced[best]), a + int(begin[best])


def _index(key: str, items: list[tuple[int, bytes]]) -> Index:
    """The index of the block that this worker searched last."""
    held = kept("benchmark")
    if key not in held:
        held.clear()
        held[key] = Index(items)
    return held[key]


def _search(docs: DataFrame, items: list[tuple[int, bytes]]) -> DataFrame:
    key = uuid.uuid4().hex
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = _index(key, sent.value)

        def solve(held):
            ids, texts = zip(*held, strict=True)
            sizes = np.asarray([len(x) for x in texts])
            # A blank of -3 after each document.
            flat = np.concatenate([x for t in texts for x in (t, [-3])])
            start = np.r_[0, np.cumsum(sizes + 1)]
            of = np.repeat(np.arange(len(texts)), sizes + 1)
            rows = [(ids[d], *rest) for d, *rest in at.matches(flat, of, start)]
            return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=kinds)

        held, n = [], 0
        for b in batches:
            for doc, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                w = words(raw.as_buffer().to_pybytes() if raw.is_valid else None)
                held.append((doc, np.fromiter((at.number.get(x, -1) for x in w), np.int64, len(w))))
                n += len(w)
                if n >= BATCH_WORDS:
                    yield solve(held)
                    held, n = [], 0
        if held:
            yield solve(held)

    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = pa.schema([(c.split()[0], pa.int32() if c.endswith("int") else pa.int64()) for c in SCHEMA.split(", ")])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("raw")).mapInArrow(tidy(run), SCHEMA)


def _blocks(benchmark: DataFrame, block_words: int) -> list[DataFrame]:
    """``benchmark`` in as few hashed blocks as keep each one within ``block_words`` (or one text)."""
    sized = benchmark.withColumn("n", F.size(F.split(F.col("raw").cast("string"), r"\s+")))
    n = 1
    while True:
        part = F.pmod(F.xxhash64("raw"), F.lit(n))
        over = sized.groupBy(part.alias("part")).agg(F.sum("n").alias("n"), F.countDistinct("raw").alias("texts")).filter(f"n > {block_words} AND texts > 1")
        if over.isEmpty():
            return [benchmark.filter(part == k) for k in range(n)]
        n *= 2


def contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per (doc_id, item_id) that share a passage: words equal and replaced, where it begins."""
    texts = benchmark.filter("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").cast("binary").alias("raw"))
    found = None
    for block in _blocks(texts, block_words):
        items = [(r["item_id"], bytes(r["raw"])) for r in block.collect()]  # bounded by block_words
        part = _search(docs, items)
        found = part if found is None else found.unionByName(part)
    rank = F.struct("matched", (-F.col("replaced")).alias("replaced"), (-F.col("doc_word")).alias("doc_word"), (-F.col("item_word")).alias("item_word"), "item_words")
    best = found.groupBy("doc_id", "item_id").agg(F.max(rank).alias("b"))
    return best.select("doc_id", "item_id", "b.matched", (-F.col("b.replaced")).alias("replaced"), (-F.col("b.doc_word")).alias("doc_word"),
                       (-F.col("b.item_word")).alias("item_word"), "b.item_words")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a benchmark passage, columns as they are.

    Rows are told apart by a hash of doc_id and text, so of different texts under one
    doc_id, or without one, only the contaminated go.
    """
    bad = contaminated(docs.select(row_key().alias("doc_id"), "text"), benchmark).select("doc_id").distinct()
    bad = staged(bad, "contaminated")  # of known size, so that texts are not shuffled to meet a few keys
    name = fresh("key", docs)
    return docs.withColumn(name, row_key()).join(bad.withColumnRenamed("doc_id", name), name, "left_anti").select(docs.columns)
