"""SimHash near duplicates by a hierarchical index over fingerprints in Gray order.

Equal fingerprints collapse to one first, so a group of copies is one entry.  Two
fingerprints within three bits agree on at least one of four masks of 16 bits; each
fingerprint goes to the nodes of its four masked patterns, and a node that holds more than
``max_node`` entries is factored further by four masks over its free bits, up to three
times.  Inside a node the entries lie in Gray rank order, where neighbours differ in few
bits.  Runs of eight are joined into upper nodes that hold the bits all of them share;
a query walks down from the root, adds the differences of the bits that each level fixes
in addition, drops a whole group beyond the bit limit and accepts a whole group where not
even its free bits can reach the limit.  A task gives a spanning forest of the links it
finds, not the pairs; stars over those forests give the components.

Edge cases: a null or empty text has fingerprint zero and links like any other; copies and
repeated rows share a fingerprint, hence a component; rows without a doc_id get a
fingerprint but name no component (null if their whole group has none); an empty table
gives an empty result; other columns are not read, ``keep_one_of_each`` carries them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, join_sized, row_key, staged, tidy

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
FANOUT = 8
#: Times that a node is factored: 16, 28, 37, 44 bits are then equal in it.
FACTORED = 3
#: Entries of one node that a task indexes (8 bytes each); larger nodes are factored.
MAX_NODE = 1_000_000
#: Pairs of query and node that a task holds at once.
FRONTIER = 1_000_000
#: Bytes of text that are shingled at once.
BLOCK_BYTES = 1 << 20
_ALL = (1 << 64) - 1


def _word_blocks(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, A-Z lower-cased, in blocks of bounded size.

    ``bytes.lower`` maps A-Z only and ``bytes.split`` cuts at U+0020 and U+0009 to U+000D.
    """
    if len(raw) <= BLOCK_BYTES:
        yield raw.lower().split()
        return
    at = 0
    while at < len(raw):
        end = min(len(raw), at + BLOCK_BYTES)
        while end < len(raw) and raw[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield raw[at:end].lower().split()
        at = end


def fingerprint(raw: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text, zero without words."""
    from xxhash import xxh64_intdigest

    counts, total, tail = np.zeros(64, dtype=np.int64), 0, []
    for block in _word_blocks(raw):
        words = tail + block
        if len(words) >= shingle:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = [0, *(ends[:len(words) - shingle] + 1).tolist()]
            hashes = np.fromiter((xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:].tolist(), strict=True)),
                                 np.uint64, len(starts))
            for k in range(0, len(hashes), 1 << 16):
                part = hashes[k:k + (1 << 16)]
                counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(hashes)
            tail = words[len(words) - shingle + 1:] if shingle > 1 else []
        else:
            tail = words
    if not total:
        if not tail:
            return 0
        return xxh64_intdigest(b" ".join(tail), SEED)
    bits = counts * 2 > total
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, *keys: Column) -> DataFrame:
    """(doc_id, fp long), one row per row of ``docs``; ``keys`` are long columns to carry along."""
    names = ["doc_id", *[f"key{i}" for i in range(len(keys))], "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"", shingle) for x in b.column(0)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(fps.view(np.int64))], names)

    return docs.select(F.col("text").cast("string").cast("binary").alias("raw"), F.col("doc_id").cast("long").alias("doc_id"),
                       *[k.alias(f"key{i}") for i, k in enumerate(keys)]).mapInArrow(tidy(run), ", ".join(f"{n} long" for n in names))


# Masks and node keys

def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _parts(mask: int, n: int) -> list[int]:
    """The free bits of ``mask`` (from the highest) in ``n`` parts of nearly equal size, each joined to ``mask``."""
    free = [b for b in range(63, -1, -1) if not mask >> b & 1]
    cut = [len(free) * i // n for i in range(n + 1)]
    return [mask | sum(1 << b for b in free[a:z]) for a, z in zip(cut, cut[1:], strict=False) if z > a]


def _gray_rank(fp: Column) -> Column:
    """Rank of a Gray code word: bit i is the parity of the bits from i up."""
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp


def _node_rows(fps: DataFrame, masks: Column) -> DataFrame:
    return fps.select("fp", F.explode(masks).alias("mask")).select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"))


def _nodes(fps: DataFrame, max_bits: int, max_node: int) -> DataFrame:
    """(fp, mask, bits): each fingerprint in every node whose masked pattern it has."""
    masks = _parts(0, max_bits + 1)
    rows = _node_rows(fps, F.array(*[F.lit(_signed(m)) for m in masks]))
    done = None
    for _ in range(FACTORED):
        hot = rows.groupBy("mask", "bits").count().filter(F.col("count") > max_node).select("mask", "bits")
        hot = staged(hot, "hot-nodes")
        deeper = {m: _parts(m, max_bits + 1) for m in masks}
        if hot.isEmpty():
            break
        cold = rows.join(hot, ["mask", "bits"], "left_anti").select("fp", "mask", "bits")
        done = cold if done is None else done.unionByName(cold)
        choose = F.create_map(*[x for m, p in deeper.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(q)) for q in p]))])
        rows = staged(_node_rows(rows.join(hot, ["mask", "bits"], "left_semi").withColumnRenamed("mask", "was"), choose[F.col("was")]).distinct(), "factored")
        masks = [q for p in deeper.values() for q in p]
    return rows if done is None else done.unionByName(rows)


# The index of one task

def _runs(codes: np.ndarray, shared: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pattern and mask of the bits that all members of each run share."""
    every, some = np.bitwise_and.reduceat(codes, starts), np.bitwise_or.reduceat(codes, starts)
    return every, np.bitwise_and.reduceat(shared, starts) & (every | ~some)


def _levels(codes: np.ndarray, group: np.ndarray) -> list[dict]:
    """Levels from the leaves up to one root per group; each node knows its first and last child and leaf."""
    lo = np.arange(len(codes))
    level = {"code": codes, "shared": np.full(len(codes), _ALL, np.uint64), "group": group, "leaf": lo, "end": lo + 1}
    out = [level]
    while True:
        g = level["group"]
        first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        if len(first) == len(g):
            return out
        within = np.arange(len(g)) - np.repeat(first, np.diff(np.r_[first, len(g)]))
        starts = np.flatnonzero(within % FANOUT == 0)
        code, shared = _runs(level["code"], level["shared"], starts)
        stops = np.r_[starts[1:], len(g)]
        level = {"code": code, "shared": shared, "group": g[starts], "child": starts, "stop": stops,
                 "leaf": level["leaf"][starts], "end": level["end"][stops - 1]}
        out.append(level)


def _search(levels: list[dict], queries: np.ndarray, codes: np.ndarray, root: np.ndarray, free: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, first leaf, last leaf + 1) of the groups within ``limit`` bits of a query."""
    top = levels[-1]
    node = root
    q = queries
    acc = np.bitwise_count((codes[q] ^ top["code"][node]) & top["shared"][node]).astype(np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for depth in range(len(levels) - 1, -1, -1):
        at = levels[depth]
        live = acc <= limit
        q, node, acc = q[live], node[live], acc[live]
        whole = acc + np.bitwise_count(free[q] & ~at["shared"][node]) <= limit
        found.append((q[whole], at["leaf"][node[whole]], at["end"][node[whole]]))
        q, node, acc = q[~whole], node[~whole], acc[~whole]
        if not depth or not len(q):
            break
        below = levels[depth - 1]
        n = at["stop"][node] - at["child"][node]
        kid = np.repeat(at["child"][node] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        q, up, acc = np.repeat(q, n), np.repeat(node, n), np.repeat(acc, n)
        acc = acc + np.bitwise_count((codes[q] ^ below["code"][kid]) & below["shared"][kid] & ~at["shared"][up])
        node = kid
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each one's component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label != label[label]).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def _forest(codes: np.ndarray, mask: np.ndarray, group: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links inside each group; ``codes`` in Gray order by group."""
    size = np.bincount(group)[group]
    many = size > 1
    codes, mask, size = codes[many], mask[many], size[many]
    if not len(codes):
        return codes, codes
    group = np.unique(group[many], return_inverse=True)[1]
    levels = _levels(codes, group)
    free = ~mask
    label = np.arange(len(codes))
    # A query may meet each entry of its group once: so many at a time that the frontier stays bounded.
    cost = np.cumsum(np.minimum(size, FRONTIER))
    cuts = [0, *(np.flatnonzero(np.diff(cost // FRONTIER)) + 1).tolist(), len(codes)]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        q, first, end = _search(levels, np.arange(lo, hi), codes, group[lo:hi], free, limit)
        # All leaves of an accepted run link to the query: a run of links between neighbours stands for them.
        step = np.zeros(len(codes) + 1, np.int64)
        np.add.at(step, first, 1)
        np.add.at(step, end - 1, -1)
        chain = np.flatnonzero(np.cumsum(step)[:-1] > 0)
        a, b = np.r_[q, chain], np.r_[first, chain + 1]
        label = _components(len(codes), np.r_[np.arange(len(codes)), a], np.r_[label, b])
    linked = label != np.arange(len(codes))
    return codes[linked], codes[label[linked]]


def links(fps: DataFrame, max_bits: int = MAX_BITS, max_node: int = MAX_NODE) -> DataFrame:
    """(a, b): a spanning forest of the links between distinct fingerprints, node by node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rows = 0

        def solve(parts, last):
            nonlocal held, rows
            mask, bits, fp = (np.concatenate(x) for x in zip(*parts, strict=True))
            new = np.r_[True, (mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])]
            group = np.cumsum(new) - 1
            keep = len(fp) if last else int(np.flatnonzero(new)[-1])
            held, rows = [(mask[keep:], bits[keep:], fp[keep:])], len(fp) - keep
            if not keep:
                return None
            a, b = _forest(fp[:keep].view(np.uint64), mask[:keep].view(np.uint64), group[:keep], max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
            rows += batch.num_rows
            if rows >= 200_000:
                if (out := solve(held, False)) is not None:
                    yield out
        if rows:
            yield solve(held, True)

    nodes = _nodes(fps, max_bits, max_node)
    return (nodes.repartition("mask", "bits")
            .sortWithinPartitions("mask", "bits", _gray_rank(F.col("fp").bitwiseAND(F.bitwise_not("mask"))))
            .select("mask", "bits", "fp").mapInArrow(run, "a long, b long"))


# Components

def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, by large and small stars.

    Every round is a grouped minimum (combined before the shuffle) and a join back, so a
    hub with many neighbours never sits in one task whole; the edges are written each
    round, and the rounds end when they no longer change.
    """
    e = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = staged(small.unionByName(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(now) == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = tuple(now)


def _groups(distinct: DataFrame, max_bits: int, max_node: int) -> DataFrame:
    """(fp, low): of rows (fp, first), the smallest ``first`` reachable over links; fingerprints without a link are left out."""
    roots = components(links(distinct.select("fp"), max_bits, max_node))
    member = roots.unionByName(roots.select(F.col("root").alias("node"), F.col("root")).distinct())
    member = member.join(distinct.withColumnRenamed("fp", "node"), "node")
    lowest = member.groupBy("root").agg(F.min("first").alias("low"))
    return member.join(lowest, "root").select(F.col("node").alias("fp"), "low")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, max_node: int = MAX_NODE) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    component_id is the smallest doc_id reachable over links of at most ``max_bits``
    differing bits.
    """
    rows = staged(fingerprints(docs, shingle), "fingerprints")
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "distinct-fingerprints")
    of = distinct.join(_groups(distinct, max_bits, max_node), "fp", "left").select("fp", "n", F.coalesce("low", "first").alias("component_id"))
    return (join_sized(rows, staged(of, "components"), "fp", "n")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, max_node: int = MAX_NODE) -> DataFrame:
    """One row of each group of near duplicates, columns as they are.

    It is the one with the smallest doc_id, rows without one last, and of different texts
    under that doc_id the one with the smallest hash of both; of repeated rows one stays.
    """
    rows = staged(fingerprints(docs, shingle, row_key()).withColumnRenamed("key0", "key"), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")
    distinct = staged(rows.groupBy("fp").agg(first), "distinct-fingerprints")
    of = distinct.join(_groups(distinct, max_bits, max_node), "fp", "left")
    leads = of.select(F.coalesce("low", "first")["key"].alias("key")).distinct().withColumn("leads", F.lit(True))
    # By row key, not by fingerprint, of which one may hold a third of all rows.
    ids = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).join(leads, "key", "left")
    # Written, so that their sizes are known and texts are shuffled only where the keys are too many to broadcast.
    odd = staged(ids.filter("n > 1 OR leads IS NULL"), "not-kept-as-is")
    again = staged(odd.filter("leads"), "repeated-rows")
    name = fresh("key", docs)
    keyed = docs.withColumn(name, row_key())
    once = keyed.join(odd.select(F.col("key").alias(name)), name, "left_anti")
    return once.unionByName(keyed.join(again.select(F.col("key").alias(name)), name, "left_semi").dropDuplicates([name])).select(docs.columns)
