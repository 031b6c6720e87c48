"""Language identification by n-gram sets of all languages in one bit-sliced Bloom filter.

Each language has the set of character n-grams (``SIZES``) that are common in it and not
far commoner elsewhere.  The Bloom filters of all languages share their hash functions and
lie across each other: a position of the filter holds a word with one bit per language, and
the bitwise and of an n-gram's positions is the mask of all languages that contain it, in
``HASHES`` reads whatever the number of languages.  A text's n-grams are looked up one and
all; the bits of each language are counted, and since a language with fill rate f answers yes by
mistake with probability f^HASHES, the count c of N n-grams is corrected to
(c - N f^h) / (1 - f^h).  The language with the highest corrected share wins, the score is
its part of the sum of all shares.

The sets are learned from about ``SAMPLE`` different texts a language (those with the
smallest hashes, so copies count once); a set holds the ``GRAMS`` n-grams of the highest
document rate at most, which bounds the filter.  Both are parameters of the model; every
text is read whole when it is judged.

Edge cases: a null text or one without a letter (``\\p{L}``) is ``und`` with score 0; a text
whose n-grams no language contains gets the language with the most learned texts, score 0;
ties go to the first language in code-point order; without learned texts all is ``und``;
case and everything but letters is ignored; repeated rows each get a row, rows without a doc_id
too; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Letters and single spaces in an n-gram.
SIZES = (2, 3, 4)
#: Different texts to learn from, and n-grams kept, for each language (at most, the first about).
SAMPLE, GRAMS = 4000, 20_000
#: Texts that an n-gram must be in, and its least rate as a share of the greatest of any language.
MIN_TEXTS, SHARE = 3, 0.8
#: Hash functions, and positions of the filter for each n-gram of the largest set (rounded up to a power of 2).
HASHES, POSITIONS = 3, 12
UNKNOWN = "und"
#: Characters that are looked up at once.
_CHARS = 1_000_000
#: n-grams a task counts before it hands them on.
_HELD = 400_000


@cache
def _letters() -> np.ndarray:
    """Lower-case letter of each code point; a space for what is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            out[c] = ord(chr(c).lower()[0])
    return out


def _symbols(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all texts with single spaces around words, and the text that each is of."""
    joined = " " + "  ".join(texts) + " "
    codes = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    of = np.repeat(np.arange(len(texts), dtype=np.int32), np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts)))
    space = codes == 32
    keep = ~space
    keep[0] = True
    # A space stays if the one before it is a letter or of another text.
    keep[1:] |= ~space[:-1] | (of[1:] != of[:-1])
    return codes[keep], of[keep]


def grams(texts: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, text) of each n-gram with a letter, for one size after another."""
    codes, of = _symbols(texts)
    wide = codes.astype(np.uint64)
    for n in SIZES:
        m = len(codes) - n + 1
        if m <= 0:
            return
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = (h ^ wide[k:k + m]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        whole = of[:m] == of[n - 1:]
        yield h[whole], of[:m][whole]


def _slices(texts: Sequence[str]) -> Iterator[list[str]]:
    """Texts in runs of about _CHARS characters, one at least."""
    held: list[str] = []
    size = 0
    for t in texts:
        if held and size + len(t) > _CHARS:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def _positions(h: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """HASHES positions of each hash in a filter of 2 ** bits."""
    second = (h * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    for _ in range(HASHES):
        yield (h >> np.uint64(64 - bits)).astype(np.int64)
        h = h + second


@dataclass
class Model:
    """The bit-sliced filter: ``words[p, w]`` holds the bits of languages 64 w and up at position p."""

    langs: list[str]
    default: str
    words: np.ndarray
    wrong: np.ndarray  # chance that a language contains an n-gram by mistake

    def masks(self, h: np.ndarray) -> np.ndarray:
        """The languages that contain each n-gram, one bit each."""
        bits = len(self.words).bit_length() - 1
        out = None
        for at in _positions(h, bits):
            out = self.words[at] if out is None else out & self.words[at]
        return out

    def shares(self, texts: Sequence[str]) -> np.ndarray:
        """Corrected share of each text's n-grams that each language contains."""
        total = np.zeros(len(texts))
        count = np.zeros((len(texts), len(self.langs)))
        for h, of in grams(texts):
            if not len(h):
                continue
            masks = self.masks(h)
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            who = of[first]
            total[who] += np.diff(np.r_[first, len(of)])
            for i in range(len(self.langs)):
                bit = (masks[:, i // 64] >> masks.dtype.type(i % 64)) & masks.dtype.type(1)
                count[who, i] += np.add.reduceat(bit, first, dtype=np.int64)
        n = np.maximum(total, 1)[:, None]
        return np.maximum(count - n * self.wrong, 0) / (1 - self.wrong) / n


def _build(langs: list[str], default: str, held: list[np.ndarray]) -> Model:
    """The filter over the n-gram hashes of each language."""
    bits = max(16, int(np.ceil(np.log2(POSITIONS * max((len(h) for h in held), default=1) + 1))))
    kind = np.uint8 if len(langs) <= 8 else np.uint16 if len(langs) <= 16 else np.uint32 if len(langs) <= 32 else np.uint64
    words = np.zeros((1 << bits, max(1, -(-len(langs) // 64))), kind)
    wrong = np.zeros(len(langs))
    for i, h in enumerate(held):
        bit = kind(1) << kind(i % 64)
        for at in _positions(h, bits):
            words[at, i // 64] |= bit
        wrong[i] = min(0.99, float(((words[:, i // 64] & bit) != 0).mean()) ** HASHES)
    return Model(langs, default, words, wrong)


def held_out() -> Column:
    """Rows that are not learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE, most: int = GRAMS) -> Model:
    """Learn from the rows with text and lang that are not held out."""
    known = docs.filter(~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).filter(F.col("text").rlike(r"\p{L}"))
    hashed = known.withColumn("h", F.xxhash64("text"))
    # Languages are few, and their counts of different texts give each a hash limit.
    sizes = {r["lang"]: r["n"] for r in hashed.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], UNKNOWN, np.zeros((1 << 16, 1), np.uint8), np.zeros(0))
    limit = F.create_map(*[F.lit(x) for name in langs for x in (name, min((1 << 63) - 1, int(-(1 << 63) + (1 << 64) * min(1.0, sample / sizes[name]))))])
    chosen = hashed.filter(F.col("h") <= limit[F.col("lang")]).groupBy("lang", "h").agg(F.first("text").alias("text")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[int, int]] = {}
        texts: dict[str, int] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang in texts:
                own = held.get(lang, {})
                yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(own) + 1)), pa.array([*own, None], pa.int64()),
                                                  pa.array([*own.values(), texts[lang]], pa.int64())], ["lang", "gram", "n"])
            held.clear()
            texts.clear()

        for b in batches:
            names, rows = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lang in dict.fromkeys(names):
                mine = [t for x, t in zip(names, rows, strict=True) if x == lang]
                texts[lang] = texts.get(lang, 0) + len(mine)
                own = held.setdefault(lang, {})
                for part in _slices(mine):
                    for h, of in grams(part):
                        order = np.lexsort((of, h))
                        h, of = h[order], of[order]
                        once = h[np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (of[1:] != of[:-1])])] if len(h) else h
                        values, n = np.unique(once, return_counts=True)
                        for v, k in zip(values.view(np.int64).tolist(), n.tolist(), strict=True):
                            own[v] = own.get(v, 0) + k
                    if sum(map(len, held.values())) > _HELD:
                        yield from out()
                        own = held.setdefault(lang, {})
                        texts.setdefault(lang, 0)
        yield from out()

    counted = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = counted.filter("gram IS NULL").select("lang", F.col("n").alias("texts"))
    rates = counted.filter(F.col("gram").isNotNull() & (F.col("n") >= MIN_TEXTS)).join(F.broadcast(totals), "lang").select(
        "lang", "gram", (F.col("n") / F.col("texts")).alias("rate"))
    common = rates.withColumn("top", F.max("rate").over(Window.partitionBy("gram"))).filter(F.col("rate") >= SHARE * F.col("top"))
    ranked = common.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("rate"), "gram"))).filter(F.col("r") <= most)
    kept = ranked.select("lang", "gram").toArrow()  # at most ``most`` longs a language
    of = np.asarray(kept["lang"].to_pylist(), object)
    h = kept["gram"].to_numpy().astype(np.int64).view(np.uint64)
    default = min(langs, key=lambda x: (-sizes[x], x))
    return _build(langs, default, [np.sort(h[of == lang]) for lang in langs])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): one row per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # langs and ``GRAMS`` bound its size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        names = [*m.langs, m.default, UNKNOWN]
        for b in batches:
            texts, lettered = b.column(2).to_pylist(), np.asarray(b.column(3).to_pylist(), bool)
            best, score = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
            asked = np.flatnonzero(lettered) if m.langs else np.zeros(0, np.int64)
            done = 0
            for part in _slices([texts[i] for i in asked.tolist()]):
                shares = m.shares(part)
                at, done = asked[done:done + len(part)], done + len(part)
                top, total = shares.max(axis=1), shares.sum(axis=1)
                best[at] = np.where(top > 0, shares.argmax(axis=1), len(m.langs))
                score[at] = np.where(top > 0, top / np.maximum(total, 1e-300), 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([names[i] for i in best.tolist()]), pa.array(score)],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text.alias("text"), text.rlike(r"\p{L}").alias("lettered"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
