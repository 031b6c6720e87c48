"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

The fixed patterns give the base spans.  They are also the seeds: the words around them
are lexical patterns (one word before, two words before, one word after), and other tokens
that hold a digit or an at sign, found in the same contexts, are unseen candidates.  Spark
scores the graph of patterns and instances in rounds: a pattern is worth the sum of its
instances' scores over all different tokens that the corpus has in its context, an unseen instance
is as certain as its confident patterns make it (one minus the product of their doubts), seeds stay
certain.  Instances of patterns of high confidence give further spans of the patterns'
kind.

A pattern needs ``MIN_INSTANCES`` different seeds, whatever the size of the input.  The
patterns stay in Spark: the tasks of the second scan get a bit table of their hashes, which
leaves out the contexts that are surely no pattern, and a join with the patterns decides.

Spans are in code points, end exclusive.  Added spans never touch base spans.

Edge cases: null and empty texts have no spans; copies and repeated rows each get their own
row with equal spans, but count once as evidence; rows without a doc_id get a row;
texts are scanned whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import md5
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, staged

#: Fixed values of the contract.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

#: Different seeds that a pattern needs.
MIN_INSTANCES = 3
#: Rounds of scoring, and the confidence that patterns and added instances need.
ROUNDS, CONFIDENT = 3, 0.5

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGES = ".,;:!?()[]{}<>\"'"
#: Words next to a span are looked for within so many characters first, then further.
_NEAR = 200
#: Hashes of patterns go to a table of two to the power of so many bits.
_TABLE_BITS = 27
#: Pairs of pattern and unit, different words, and different pairs of words that a task holds at once.
_PAIRS, _WORDS, _TWOS = 1_000_000, 400_000, 1_000_000


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from their at signs: the part before one is
    the run of its characters back to the last match, the part after it is fixed."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        if m:
            a = at
            while a > last and text[a - 1] in _LOCAL:
                a -= 1
            if a < at:
                out.append((a, m.end()))
                last = m.end()
                at = text.find("@", last)
                continue
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of the fixed patterns by kind, in order."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = _emails(text)
    if _DIGIT.search(text):
        # A match can only begin where a run of digits begins: inside it, it would end in the same way.
        out["ip"] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    out["card"].append(m.span())
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                    out["phone"].append(m.span())
    return out


def contexts(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns around a span."""
    near = _NEAR
    while len(before := _WORD.findall(text[max(0, start - near):start])) < 3 and near < start:
        near *= 4  # the first of three may be cut, the two behind it are whole
    before, near = before[-2:], _NEAR
    while ((word := _WORD.search(text, end, end + near)) is None or word.end() == end + near) and end + near < len(text):
        near *= 4
    after = [word.group()] if word else []
    before = [w.lower().strip(_EDGES) or w for w in before]
    out = []
    if before:
        out.append("L1 " + before[-1])
    if len(before) == 2:
        out.append("L2 " + " ".join(before))
    if after:
        out.append("R1 " + (after[0].lower().strip(_EDGES) or after[0]))
    return out


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in _EDGES:
        start += 1
    while end > start and text[end - 1] in _EDGES:
        end -= 1
    return start, end


def _looks_like_id(token: str) -> bool:
    return len(token) >= 5 and ("@" in token or _DIGIT.search(token) is not None)


def _touched(text: str, places: list[tuple[int, int]]) -> dict[int, tuple[str, str]]:
    """The first and the last base span in each of the words at ``places`` that one touches."""
    out: dict[int, tuple[str, str]] = {}
    ends = [z for _, z in places]
    for a, z in sorted(s for v in base_spans(text).values() for s in v):
        i = bisect_right(ends, a)
        while i < len(places) and places[i][0] < z:
            out[i] = (out[i][0] if i in out else text[a:z], text[a:z])
            i += 1
    return out


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def _scan(docs: DataFrame) -> DataFrame:
    """(key, doc_id, spans, seeds): base spans and their contexts, one row per row of (key, doc_id, text)."""
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    seed = pa.list_(pa.struct([("pattern", pa.string()), ("kind", pa.string()), ("instance", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, seeds = [], []
            for t in b.column(2).to_pylist():
                found = base_spans(t)
                spans.append([{"kind": k, "start": a, "end": z} for k in KINDS for a, z in found[k]])
                seeds.append([{"pattern": p, "kind": k, "instance": t[a:z]} for k in KINDS for a, z in found[k] for p in contexts(t, a, z)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(spans, span), pa.array(seeds, seed)], ["key", "doc_id", "spans", "seeds"])

    return docs.mapInArrow(run, f"key long, doc_id long, spans {_SPANS}, seeds array<struct<pattern:string,kind:string,instance:string>>")


def _bit_table(patterns: DataFrame) -> bytes:
    """A bit for the hash of each pattern, and of the last word of a pattern of two."""
    key = F.explode(F.array_compact(F.array("pattern", F.when(F.col("pattern").startswith("L2 "), F.concat(F.lit("2 "), F.substring_index("pattern", " ", -1))))))
    at = patterns.select(key.alias("key")).select((F.crc32(F.col("key").cast("binary")) % (1 << _TABLE_BITS)).alias("at"))
    bits = at.groupBy((F.col("at") / 64).cast("long").alias("place")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 AS int))")).alias("bits")).toArrow()
    table = np.zeros(1 << (_TABLE_BITS - 6), "<i8")  # 16 MB, which also bounds the rows collected
    table[bits["place"].to_numpy()] = bits["bits"].to_numpy()
    return table.tobytes()


def _hash(text: str) -> int:
    """60 bits, as ``hashed`` has them in Spark."""
    return int(md5(text.encode("utf-8", "replace")).hexdigest()[:15], 16)


def hashed(text: str) -> Column:
    return F.conv(F.substring(F.md5(F.col(text).cast("binary")), 1, 15), 16, 10).cast("long")


#: CRC-32 goes on from what a pattern begins with, so a word is encoded once for all its patterns.
_LEFT, _RIGHT, _PAIR, _TWO = (crc32(x) for x in (b"L1 ", b"R1 ", b"L2 ", b"2 "))


class _Words(dict):
    """Numbers of the words met as they stand, and what is known of each.

    ``before`` and ``after``: the number of the pattern that has the word there, or -1;
    ``kind``: 1 if it may be the last of a pattern of two, plus 2 if it looks like an identifier.
    ``two`` has the number of the pattern of two words, or -1, under both their numbers;
    ``units`` the hash of a word as an instance, made when it is one.
    """

    def __init__(self, table: bytes):
        super().__init__()
        self.table, self.patterns, self.names = table, {}, []
        self.word, self.token, self.rows = [], [], array("q")
        self.two, self.units = _Pairs(self), _Units(self)

    def may_be(self, crc: int) -> bool:
        h = crc & ((1 << _TABLE_BITS) - 1)
        return bool(self.table[h >> 3] >> (h & 7) & 1)

    def pattern(self, crc: int, kind: str, word: str) -> int:
        h = crc & ((1 << _TABLE_BITS) - 1)
        if not self.table[h >> 3] >> (h & 7) & 1:
            return -1
        key = kind + word
        if key not in self.patterns:
            self.patterns[key] = len(self.patterns)
            self.names.append(key)
        return self.patterns[key]

    def __missing__(self, raw: str) -> int:
        a, z = _trimmed(raw, 0, len(raw))
        w = raw.lower().strip(_EDGES) or raw.lower()
        coded, token = w.encode("utf-8", "replace"), raw[a:z]
        self[raw] = n = len(self)
        self.word.append(w)
        self.token.append(token or raw)
        self.rows.extend((self.pattern(crc32(coded, _LEFT), "L1 ", w), self.pattern(crc32(coded, _RIGHT), "R1 ", w),
                          self.may_be(crc32(coded, _TWO)) + 2 * _looks_like_id(token)))
        return n


class _Units(dict):
    """Hash of a word as an instance, by its number."""

    def __init__(self, words: _Words):
        super().__init__()
        self.words = words

    def __missing__(self, n: int) -> int:
        self[n] = h = _hash(self.words.token[n])
        return h


class _Pairs(dict):
    """Number of the pattern of two words, or -1, by the numbers of both."""

    def __init__(self, words: _Words):
        super().__init__()
        self.words = words

    def __missing__(self, pair: int) -> int:
        word = self.words.word
        both = f"{word[pair >> 32]} {word[pair & 0xFFFFFFFF]}"
        self[pair] = n = self.words.pattern(crc32(both.encode("utf-8", "replace"), _PAIR), "L2 ", both)
        return n


def _candidates(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """What the patterns, and few other contexts, have in them over all texts.

    Rows (pattern, units) hold the hashes of what is there, a token or the base span that it
    touches, each once for a part of a task; rows with a key are tokens that look like
    identifiers and lie outside base spans, each with its place.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_bit_table(patterns))
    names = ["key", "start", "end", "instance", "pattern", "n", "units"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64())]

    def counted(words: _Words, pairs: list[np.ndarray]) -> pa.RecordBatch:
        """The rows of (pattern, units) of ``pairs``."""
        number, unit = np.concatenate(pairs, axis=1)
        order = np.lexsort((unit, number))
        number, unit = number[order], unit[order]
        new = np.r_[True, (np.diff(number) != 0) | (np.diff(unit) != 0)]
        number, unit = number[new], unit[new]
        start = np.flatnonzero(np.r_[True, np.diff(number) != 0])
        columns = [pa.nulls(len(start), k) for k in kinds[:4]] + [pa.array([words.names[i] for i in number[start].tolist()], kinds[4]),
                                                                 pa.array(np.diff(np.r_[start, len(unit)]), kinds[5])]
        return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(np.r_[start, len(unit)], pa.int32()), pa.array(unit))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, n = _Words(sent.value), [], 0
        for b in batches:
            rows = []
            for doc, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                t = raw.as_py()
                at = np.asarray([words[x] for x in _WORD.findall(t)], np.int64)
                if len(at) < 2:
                    continue
                before, after, kind = np.frombuffer(words.rows, np.int64).reshape(-1, 3)[at].T
                left, right = np.flatnonzero(before[:-1] >= 0), np.flatnonzero(after[1:] >= 0)
                last = np.flatnonzero(kind[1:-1] & 1) + 1
                pairs_of = (at[last - 1] << 32) | at[last]
                two = np.fromiter(map(words.two.__getitem__, pairs_of.tolist()), np.int64, len(last))
                last, two = last[two >= 0], two[two >= 0]
                # (place, pattern, whether the pattern is behind)
                place = np.r_[left + 1, last + 1, right]
                number = np.r_[before[left], two, after[right + 1]]
                if not len(place):
                    continue
                behind = np.arange(len(place)) >= len(left) + len(two)
                found = np.fromiter(map(words.units.__getitem__, at[place].tolist()), np.int64, len(place))
                like = (kind[place] & 2) > 0
                taken = any(base_spans(t).values())
                if taken or like.any():
                    places = [m.span() for m in _WORD.finditer(t)]
                    touched = _touched(t, places) if taken else {}
                    for k in np.flatnonzero(like | np.isin(place, list(touched))).tolist():
                        i = int(place[k])
                        if i in touched:
                            found[k] = _hash(touched[i][int(behind[k])])
                        else:
                            a, z = _trimmed(t, *places[i])
                            rows.append((doc, a, z, t[a:z], words.names[number[k]], None, None))
                pairs.append(np.stack([number, found]))
                n += len(place)
                if n >= _PAIRS or len(words) >= _WORDS or len(words.two) >= _TWOS:
                    yield counted(words, pairs)
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    words, pairs, n, rows = _Words(sent.value) if len(words) >= _WORDS or len(words.two) >= _TWOS else words, [], 0, []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
        if pairs:
            yield counted(words, pairs)

    return docs.mapInArrow(run, "key long, start int, end int, instance string, pattern string, n long, units array<long>")


def _score(links: DataFrame, uses: DataFrame, confident: float) -> tuple[DataFrame, DataFrame]:
    """(pattern, confidence, kind) and (instance, score) after ROUNDS rounds over the graph.

    ``links``: (pattern, instance, kind, n), kind null for unseen instances.  Confident
    patterns alone score their instances.
    """
    seeds = links.filter("kind IS NOT NULL")
    kind = seeds.groupBy("pattern", "kind").agg(F.sum("n").alias("n")).groupBy("pattern").agg(F.max_by("kind", F.struct("n", "kind")).alias("kind"))
    sure = seeds.groupBy("pattern").agg(F.sum("n").alias("sure"))
    unseen = links.filter("kind IS NULL").select("pattern", "instance", "n")
    base = uses.join(sure, "pattern").join(kind, "pattern")
    patterns = base.select("pattern", "kind", "uses", "sure", F.least(F.lit(1.0), F.col("sure") / F.col("uses")).alias("confidence"))
    scores = None
    for _ in range(ROUNDS):
        doubt = F.sum(F.log(F.greatest(F.lit(1e-6), 1 - F.col("confidence"))))
        scores = unseen.join(patterns.filter(F.col("confidence") >= confident), "pattern").groupBy("instance").agg((1 - F.exp(doubt)).alias("score"))
        scores = staged(scores, "pii-instances")
        more = unseen.join(scores, "instance").groupBy("pattern").agg(F.sum(F.col("n") * F.col("score")).alias("more"))
        patterns = base.join(more, "pattern", "left").select("pattern", "kind", "uses", "sure", F.least(
            F.lit(1.0), (F.col("sure") + F.coalesce("more", F.lit(0.0))) / F.col("uses")).alias("confidence"))
        patterns = staged(patterns, "pii-patterns")
    return patterns, scores


def _possible(met: DataFrame, seeds: DataFrame, confident: float) -> DataFrame:
    """(pattern): those that can still become confident.

    All its instances together, seeds and unseen, are the most that a pattern's confidence
    can have above the line, and the units of any one part of a task the least below it.
    Below ``confident`` a pattern scores and adds nothing, so leaving those out that stay
    there changes no result.
    """
    unseen = met.filter("key IS NOT NULL").select("pattern", "instance").distinct().groupBy("pattern").agg(F.count(F.lit(1)).alias("unseen"))
    least = met.filter("key IS NULL").groupBy("pattern").agg(F.max("n").alias("least"))
    sure = seeds.groupBy("pattern").agg(F.count(F.lit(1)).alias("sure"))
    return (unseen.join(sure, "pattern").join(least, "pattern", "left")
            .filter(F.col("sure") + F.col("unseen") >= confident * F.coalesce("least", F.lit(0)) * (1 - 1e-9)).select("pattern"))


def find(docs: DataFrame, confident: float = CONFIDENT) -> DataFrame:
    """(doc_id, spans, added): base spans and those that the contexts add, one row per row of ``docs``.

    The added spans are looked up by a hash of doc_id and text, which repeated rows share.
    """
    rows = doc_texts(docs).select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    found = staged(_scan(rows), "pii-base")
    # Copies count once: links are distinct (pattern, instance, kind).
    seeds = found.filter(F.size("seeds") > 0).select(F.explode("seeds").alias("s")).select("s.*").distinct()
    seeds = staged(seeds.withColumn("n", F.lit(1)), "pii-seeds")
    strong = seeds.groupBy("pattern").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= MIN_INSTANCES).select("pattern")
    strong = staged(strong, "pii-strong")
    empty = F.array().cast(_SPANS)
    if strong.isEmpty():
        return found.select("doc_id", "spans", empty.alias("added"))
    met = staged(_candidates(rows.select("key", "text"), strong), "pii-candidates")
    unseen = met.filter("key IS NOT NULL").join(strong, "pattern", "left_semi")
    # In the unit of the seeds: distinct (pattern, instance); a pattern without unseen instances is worth nothing.
    asked = staged(_possible(met, seeds.join(strong, "pattern", "left_semi"), confident), "pii-asked")
    unseen = unseen.join(asked, "pattern", "left_semi")
    uses = (met.filter("key IS NULL").join(asked, "pattern", "left_semi").select("pattern", F.explode("units").alias("unit"))
            .unionByName(seeds.join(asked, "pattern", "left_semi").select("pattern", hashed("instance").alias("unit"))).distinct()
            .groupBy("pattern").agg(F.count(F.lit(1)).alias("uses")))
    links = (seeds.join(asked, "pattern", "left_semi").select("pattern", "instance", "kind", "n")
             .unionByName(unseen.select("pattern", "instance").distinct().select("pattern", "instance", F.lit(None).cast("string").alias("kind"), F.lit(1).alias("n"))))
    scored, instances = _score(staged(links, "pii-links"), uses, confident)
    good = scored.filter(F.col("confidence") >= confident).select("pattern", "kind", "confidence")
    sure = instances.filter(F.col("score") >= confident).select("instance")
    added = (unseen.join(good, "pattern").join(sure, "instance", "left_semi").groupBy("key", "start", "end")
             .agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
             .groupBy("key").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("added")))  # one text's spans
    return found.select("key", "doc_id", "spans").join(added, "key", "left").select("doc_id", "spans", F.coalesce("added", empty).alias("added"))


def report(docs: DataFrame, confident: float = CONFIDENT) -> DataFrame:
    """The contract's digest: base counts, a hash of the base spans, and all spans as text."""
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])

    def text(spans):
        ranked = F.sort_array(F.transform(spans, lambda s: F.struct(order[s["kind"]].alias("k"), s["start"].alias("a"), s["end"].alias("z"), s["kind"].alias("kind"))))
        return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["a"].cast("string"), s["z"].cast("string"))), ",")

    def of_kind(kind):
        return lambda s: s["kind"] == kind

    number = [F.size(F.filter("spans", of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return find(docs, confident).select("doc_id", *number, F.sha2(text(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
                                        text(F.concat("spans", "added")).alias("spans"))
