"""Language bitmask filters against plain sets, and held-out accuracy."""

from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.llm import languages


def plain_grams(text):
    """Letters of words between single spaces, cut into n-grams."""
    flat = " " + " ".join("".join(c.lower()[0] if c.isalpha() else " " for c in text).split()) + " "
    flat = " " if flat == "  " else flat
    return [flat[i:i + n] for n in languages.SIZES for i in range(len(flat) - n + 1)]


def test_grams_of_a_batch_are_those_of_each_text():
    texts = ["One two", "", "  ", "É à-b", "x", "a1b", "two\nlines!", "ß Ω word" * 30]
    seen = {}
    for h, of in languages.grams(texts):
        for v, i in zip(h.tolist(), of.tolist(), strict=True):
            seen.setdefault(i, []).append(v)
    for i, t in enumerate(texts):
        alone = [v for h, _ in languages.grams([t]) for v in h.tolist()]
        assert alone == seen.get(i, [])
        assert len(alone) == len(plain_grams(t))
        assert len(set(alone)) == len(set(plain_grams(t)))


def test_filter_gives_all_languages_of_a_gram_and_corrects_its_errors():
    rng = np.random.default_rng(3)
    for n_langs in (3, 11, 70):
        pool = rng.integers(1, 1 << 63, 6000, dtype=np.uint64)
        sets = [np.unique(rng.choice(pool, 400 + 20 * i)) for i in range(n_langs)]
        model = languages._build([f"l{i:02}" for i in range(n_langs)], "l00", sets)
        masks = model.masks(pool)
        for i, s in enumerate(sets):
            bit = (masks[:, i // 64] >> masks.dtype.type(i % 64)) & masks.dtype.type(1)
            inside = np.isin(pool, s)
            assert bit[inside].all()  # never a missing language
            assert abs(bit[~inside].mean() - model.wrong[i]) < 0.02
        other = rng.integers(1, 1 << 63, 200_000, dtype=np.uint64)
        bits = (model.masks(other)[:, 0] & 1).mean()
        assert abs(bits - model.wrong[0]) < 0.002


def test_language_sets_equal_plain_counts(spark):
    """With a sample of all texts the filter holds exactly the n-grams that plain counting gives."""
    rows = [(r["doc_id"], r["lang"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows += [(1000 + i, *rows[i][1:]) for i in range(40)]  # copies count once
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = languages.fit(docs, most=10 ** 6)
    texts = {}
    for d, lang, t in rows:
        if zlib.crc32(str(d).encode()) % 4 != 2 and t is not None and any(c.isalpha() for c in t):
            texts.setdefault(lang, set()).add(t)
    rate, hashed = {}, {}
    for lang, own in texts.items():
        count = {}
        for t in own:
            for (h, _), _n in zip(languages.grams([t]), languages.SIZES, strict=False):
                for v in set(h.tolist()):
                    count[v] = count.get(v, 0) + 1
        for v, n in count.items():
            if n >= languages.MIN_TEXTS:
                rate.setdefault(v, {})[lang] = n / len(own)
    for v, by in rate.items():
        for lang, x in by.items():
            if x >= languages.SHARE * max(by.values()):
                hashed.setdefault(lang, []).append(v)
    want = languages._build(sorted(texts), model.default, [np.asarray(sorted(hashed[x]), np.uint64) for x in sorted(texts)])
    assert model.langs == want.langs and (model.words == want.words).all()


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    got = {r["doc_id"]: r for r in languages.predict(docs, languages.fit(docs)).collect()}
    want = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert got.keys() == want.keys()
    out = [d for d in want if zlib.crc32(str(d).encode()) % 4 == 2]
    assert all(got[d]["held_out"] == (d in set(out)) and 0 <= got[d]["score"] <= 1 for d in want)
    assert sum(got[d]["lang_pred"] == want[d] for d in out) >= 0.98 * len(out)


def test_language_edges(spark):
    en, fr = "the word of the house and the tree ", "le mot de la maison et les arbres "
    rng = random.Random(4)
    rows = [(i, " ".join(rng.sample((en if i % 2 else fr).split(), 6)), "en" if i % 2 else "fr") for i in range(60)]
    odd = [(100, None, "en"), (101, "", "en"), (102, "12 !?", "fr"), (103, "the house", None), (104, "Ω", "fr"), (None, "les arbres", "fr"),
           (105, "the tree " * 100_000, "en"), (106, "les maison", "en"), (106, "les maison", "en")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("score", F.lit("x")).withColumn("h", F.lit(1))
    got = languages.predict(docs, languages.fit(docs)).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert by[100] == by[101] == by[102] == ("und", 0.0)
    assert by[103][0] == by[105][0] == "en" and by[None][0] == by[106][0] == "fr"
    assert by[104] == (languages.fit(docs).default, 0.0)
    none = docs.filter("doc_id < 0")
    assert languages.predict(none, languages.fit(none)).count() == 0
    assert {r["lang_pred"] for r in languages.predict(docs, languages.fit(none)).collect()} == {"und"}
