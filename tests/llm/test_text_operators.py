"""Quality rules, SimHash, toxicity, token counts and packing against plain versions."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.llm import packing, quality, simhash, tokenizing, tokens, toxicity
from tidemark.llm.registry import vocabulary
from tidemark.llm.tokenizing import Encoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")

ODD = [None, "", " ", "\n\t", "one", "one two", "a a a a", "x " * 400, "Ünï çødé ñ", "\x1c a\x1cb", "it's we'll  don't.",
       "<|endoftext|> a <|endoftext|>", "é ̸=", "１２ 4\xbd Ⅸ", "tab\tand\r\nlines\x0b\x0c end "]


def odd_docs(spark, extra=()):
    """Odd texts, repeated rows, a null doc_id and columns that clash with the operators' own."""
    rows = [(i, t) for i, t in enumerate([*ODD, *extra])]
    rows += [rows[4], rows[7], (None, "no id here"), (None, None)]
    return spark.createDataFrame([(d, t, "x", 1, "h") for d, t in rows], "doc_id long, text string, score string, fp int, bits string")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


# Quality rules

def plain_stats(text):
    text = text or ""
    w = WORD.findall(text)
    win = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if win[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed)


def test_quality_statistics(spark, documents):
    for docs in (documents, odd_docs(spark, ["w1 w2 w3 " * 30, "same line here\n" * 20 + "other", "# | <x> " * 60])):
        want = Counter((r["doc_id"], *plain_stats(r["text"])) for r in docs.collect())
        got = Counter(tuple(r)[:-1] for r in quality.quality_report(docs).collect())
        assert got == want


def test_quality_verdicts(spark):
    good = " ".join(f"word{i % 97}x{i}" for i in range(120))
    texts = {"good": good, "short": "too short", "null": None, "symbols": good.replace(" ", "%%% "), "caps": good.upper().replace("1", "A").replace("2", "B"),
             "shout": good.replace(" ", "!! "), "lines": good + "\n" + "\n".join(["again and again"] * 30), "letters": " ".join("abcdefghij"[i % 10] for i in range(300))}
    docs = spark.createDataFrame(list(enumerate(texts.values())), "doc_id long, text string")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_report(docs).collect()}
    assert [k for k, v in zip(texts, kept.values(), strict=True) if kept[list(texts).index(k)]] == ["good"]
    assert [r["doc_id"] for r in quality.keep_quality(docs).collect()] == [0]


def test_quality_order_and_verdict_do_not_depend_on_each_other(spark, documents):
    rules = quality.BASE_RULES + quality.METHOD_RULES
    ordered = quality.order_rules(documents, rules)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in rules)
    a = sorted(r["doc_id"] for r in quality.keep_quality(documents, rules).collect())
    b = sorted(r["doc_id"] for r in quality.keep_quality(documents, rules[::-1]).collect())
    c = sorted(r["doc_id"] for r in quality.quality_report(documents).filter("kept").collect())
    assert a == b == c


def test_quality_takes_odd_rows_and_empty_tables(spark):
    docs = odd_docs(spark)
    assert quality.keep_quality(docs).columns == docs.columns
    assert quality.keep_quality(docs.limit(0)).count() == 0
    assert quality.quality_report(docs.limit(0)).count() == 0


# SimHash

def plain_fingerprint(text):
    from xxhash import xxh64_intdigest
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def plain_components(fps, limit=3):
    """Smallest member of each one's component over all pairs."""
    label = list(range(len(fps)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= limit:
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return [root(x) for x in range(len(fps))]


def test_simhash_equals_brute_force(spark, documents):
    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    fps = [plain_fingerprint(t) for _, t in rows]
    low = plain_components(fps)
    want = {d: (f"{f:016x}", rows[c][0]) for (d, _), f, c in zip(rows, fps, low, strict=True)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(documents).collect()}
    assert got == want


@pytest.mark.parametrize("max_node", [30, 1_000_000])
def test_simhash_links_in_dense_and_chained_groups(spark, max_node):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for seed in [rng.getrandbits(64) for _ in range(4)]:
        x = seed
        for _ in range(60):  # chains, three bits a step
            fps.add(x)
            for b in rng.sample(range(64), 3):
                x ^= 1 << b
        for _ in range(120):  # clouds
            y = seed
            for b in rng.sample(range(64), rng.randint(0, 6)):
                y ^= 1 << b
            fps.add(y)
    fps = sorted(fps, key=lambda f: f - (1 << 64) if f >> 63 else f)
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    roots = {r["node"] & ((1 << 64) - 1): r["root"] & ((1 << 64) - 1) for r in simhash.components(simhash.links(frame, max_node=max_node)).collect()}
    low = plain_components(fps)
    assert {f: fps[c] for f, c in zip(fps, low, strict=True) if fps[c] != f} == roots


def test_simhash_search_accepts_and_prunes_exactly():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 1, dtype=np.int64).view(np.uint64)[0]
    codes = np.unique(np.asarray([base ^ np.uint64(sum(1 << int(b) for b in rng.choice(20, rng.integers(0, 5), replace=False))) for _ in range(300)], np.uint64))
    a, b = simhash._forest(codes, np.zeros(len(codes), np.uint64), np.zeros(len(codes), np.int64), 3)
    want = plain_components([int(c) for c in codes])
    assert len(codes) - len(a) == len(set(want))
    place = {int(c): want[i] for i, c in enumerate(codes)}
    assert all(place[int(x)] == place[int(y)] for x, y in zip(a, b, strict=True))


def test_simhash_odd_rows(spark):
    docs = odd_docs(spark)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    zero = {r["component_id"] for r in got if r["fingerprint"] == "0" * 16}
    assert zero == {0}  # null, empty and blank texts, with or without a doc_id
    assert all(r["component_id"] is not None for r in got if r["doc_id"] is not None)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    ids = [r["doc_id"] for r in rows]
    assert len(set(ids) - {None}) == len(ids) - ids.count(None) and 0 in ids and 1 not in ids
    # Each group keeps one row: that of the smallest doc_id, rows without one last.
    assert len(rows) == len({r["component_id"] if r["component_id"] is not None else r["fingerprint"] for r in got})


def test_simhash_keeps_one_of_each_group_whatever_the_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    docs = spark.createDataFrame([(1, a), (1, b), (2, a), (2, b), (None, a), (None, "only one"), (None, "only one"), (1, a)], "doc_id long, text string")
    docs = docs.withColumn("key", F.lit(0)).withColumn("__id", F.lit("x"))
    for order in (docs, docs.orderBy(F.desc("text")).repartition(3)):
        kept = simhash.keep_one_of_each(order)
        assert kept.columns == docs.columns
        got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
        assert got == sorted([(1, a), (1, b), (None, "only one")], key=str)


def test_simhash_of_long_texts_in_blocks(monkeypatch):
    text = " ".join(f"W{i * i % 1013}" for i in range(3000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 100)
    assert simhash.fingerprint(text.encode()) == whole == plain_fingerprint(text)
    assert simhash.fingerprint(b"a" * 500) == plain_fingerprint("a" * 500)


# Toxicity

def test_toxicity_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.score(docs, toxicity.fit(docs, labels))
    rows = got.join(labels, "doc_id").filter("held_out").select("toxic", "predicted", "score").collect()
    toxic, clean = [r for r in rows if r["toxic"]], [r for r in rows if not r["toxic"]]
    # Some 300 toxic texts in four languages to learn from; the check tables have five times as many and more.
    assert sum(r["predicted"] for r in toxic) >= 0.9 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    assert got.count() == docs.count()


def test_toxicity_held_out_fold(spark):
    got = spark.range(50).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert {r["id"]: r["h"] for r in got} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50)}


def test_toxicity_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    for lab in (labels, labels.limit(0), labels.filter("toxic = 0")):
        got = toxicity.score(docs, toxicity.fit(docs, lab)).collect()
        assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    model = toxicity.fit(docs, labels)
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_features_of_long_texts(monkeypatch):
    text = "The quick brown fox \u00e9\n" * 50
    whole = toxicity.Features().of(text)
    t = re.sub("[\t\n\x0b\x0c\r]", " ", text.lower())
    grams = {t[i:i + n] for n in toxicity.SIZES for i in range(len(t) - n + 1)}
    assert len(whole) == len(set(whole.tolist())) == len(grams)
    monkeypatch.setattr(toxicity, "BLOCK", 37)
    assert set(toxicity.Features().of(text).tolist()) == set(whole.tolist())
    keep = np.zeros(1 << toxicity.BITS, bool)
    keep[whole[:5]] = True
    assert set(toxicity.Features(keep).of(text).tolist()) == set(whole[:5].tolist())
    assert len(toxicity.Features().of("")) == len(toxicity.Features().of("ab")) == 0


# Tokens

@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library(name, documents):
    from tokenizers import Tokenizer
    plain, fast = Tokenizer.from_file(vocabulary(name)), Encoder(vocabulary(name))
    texts = [t or "" for t in ODD] + [r["text"] for r in documents.limit(120).collect()]
    texts += ["a,b. c., d! (e). f'S. İI. ΣΣ. KK", "word. word, Word WORD.", "<|ENDOFTEXT|> <|startoftext|>x", "lé, lé. 日本."]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in fast.ids(texts)] == want
    assert fast.counts(texts).tolist() == [len(x) for x in want]


def test_encoder_of_latin_texts_equals_library(monkeypatch):
    """Every Latin-1 character, short forms and special strings, among texts of other characters and over generations."""
    from tokenizers import Tokenizer
    path = vocabulary("word_bpe_49k.json")
    plain, fast = Tokenizer.from_file(path), Encoder(path)
    rng = random.Random(11)
    latin = [*map(chr, range(256)), *"'s 't 're 've 'm 'll 'd 'S 'RE ''s 'l 're' .'s <| <|endoftext|>".split(), "' s"]
    wide = ["\u65e5\u672c", "\u03a3", "\u0130", "\u2019", "\u0307", "\u2003", "\u0958"]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(300) for pool in (latin, latin[256:] + list("ab. "), latin + 6 * wide)]
    texts += ["", " \n", "'", "x'", "x'l", "X\u0130, \u0958.", "\u00c9T\u00c9,\u00e9t\u00e9 Word word&&&. word***"]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in fast.ids(texts)] == want
    monkeypatch.setattr(tokenizing, "MAX_CHUNKS", 50)
    fast.clear()
    for k in range(0, len(texts), 7):
        assert [x.tolist() for x in fast.ids(texts[k:k + 7])] == want[k:k + 7]
        assert fast.counts(texts[k:k + 7]).tolist() == [len(x) for x in want[k:k + 7]]
    assert fast.ids([]) == [] and [len(x) for x in fast.ids(["", " "])] == [0, 0]


def test_encoder_learns_a_word_once_and_past_the_normalizer():
    """Words with other marks or capitals are no new words, and words that occur once cost no call for whole texts."""
    fast = Encoder(vocabulary("word_bpe_49k.json"))
    texts, whole = [], fast._whole
    fast._whole = lambda batch: texts.extend(batch) or whole(batch)
    new = [f"{'abcdefgh\u00e9\u00fc'[i % 10]}{'xyzv'[i % 4]}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(500)]
    fast.ids([" ".join(w.title() + mark for w in new) for mark in ("", "&&&", "%%%.", ",")])
    fast.ids(["Been here, been there***", "been (here) THERE!"])
    assert sorted(k for k in fast._at if any(map(str.isalpha, k))) == sorted([*new, "been", "here", "there"])
    assert not any(c.isalpha() for t in texts for c in t)
    # Beside other characters too: only chunks with one of them are encoded as texts.
    fast.ids(["\u2019 zq&&& Zr*** (zs),zt", "it\u2019s"])
    assert {"zq", "zr", "zs", "zt"} < set(fast._at)
    assert {t for t in texts if any(map(str.isalpha, t))} == {"it\u2019s"}


def test_token_counts_and_cache(spark, scratch, documents):
    path = vocabulary("byte_bpe_50k.json")
    docs = odd_docs(spark).select("doc_id", "text").unionByName(documents.select("doc_id", "text"))
    plain = Encoder(path)._whole
    want = Counter((r["doc_id"], len((r["text"] or "").encode()), n := len(plain([r["text"] or ""])[0]), n > 1024) for r in docs.collect())
    assert Counter(map(tuple, tokens.count_tokens(docs, path, scratch).collect())) == want
    stored = spark.read.parquet(scratch).count()
    assert stored == docs.selectExpr("coalesce(text, '') AS t").distinct().count()
    tokens.count_tokens(docs, path, scratch).count()
    assert spark.read.parquet(scratch).count() == stored  # a second run encodes nothing
    folder = f"{scratch}/tokenizer={tokens.tokenizer_digest(path)}"
    spark.read.parquet(folder).limit(50).write.mode("append").parquet(folder)  # another job added some again
    assert Counter(map(tuple, tokens.count_tokens(docs, path, scratch).collect())) == want
    assert tokens.count_tokens(docs.limit(0), path, scratch).count() == 0


def test_packing_round_trip(spark, documents):
    from tokenizers import Tokenizer
    path = vocabulary("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    docs = odd_docs(spark, ["long words here " * 9000]).select("doc_id", "text").filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    docs = docs.unionByName(documents.selectExpr("doc_id + 1000 AS doc_id", "text"))
    pieces = packing.pack(docs, path).collect()
    of_doc, of_seq = {}, {}
    for p in pieces:
        of_doc.setdefault(p["doc_id"], []).append(p)
        of_seq.setdefault(p["sequence_id"], []).append(p)
    for r in docs.collect():
        ids = [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        own = sorted(of_doc[r["doc_id"]], key=lambda p: p["start"])
        assert [x for p in own for x in np.frombuffer(p["ids"], "<u4").tolist()] == ids
        assert all(p["doc_tokens"] == len(ids) and p["length"] == len(p["ids"]) // 4 for p in own)
    for s in of_seq.values():
        at = 0
        for p in sorted(s, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 4096
    total = sum(p["length"] for p in pieces)
    assert len(of_seq) * 4096 - total < 0.03 * total + 4096 * docs.rdd.getNumPartitions()
    digest = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in packing.pack_digest(docs, path).collect()}
    assert all(digest[p["doc_id"], p["start"]] == zlib.crc32(bytes(p["ids"])) for p in pieces)
    assert packing.pack(docs.limit(0), path).count() == 0


def test_packing_cuts():
    for n in [*range(1, 300), 819, 820, 1024, 1025, 2047, 2048, 2049, 3000, 4095, 4096, 4097, 20_000]:
        cut = packing.cut_points(n)
        assert sum(x for x, _ in cut) == n and all(x * k <= 4096 for x, k in cut)
