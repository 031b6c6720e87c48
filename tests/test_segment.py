"""The learned lexicon against plain counts, and the best path against all paths."""

from __future__ import annotations

import itertools
import math
import random

import pytest

from tidemark.operators import segment


def test_scores_equal_plain_counts(spark):
    rng = random.Random(1)
    words = ["台積", "電", "漲停", "今天", "股價", "外資", "買超"]
    runs = {}
    for _ in range(150):
        r = "".join(rng.choices(words, k=rng.randint(1, 6)))
        runs[r] = runs.get(r, 0) + rng.randint(1, 3)
    grams, sides = {}, {}
    for r, n in runs.items():
        for i, m in itertools.product(range(len(r)), range(1, 5)):
            if i + m <= len(r):
                g = r[i:i + m]
                grams[g] = grams.get(g, 0) + n
                for side, c in (("l", r[i - 1:i] if i else ""), ("r", r[i + m:i + m + 1])):
                    by = sides.setdefault((g, side), {})
                    by[c] = by.get(c, 0) + n
    chars = sum(n for g, n in grams.items() if len(g) == 1)
    entropy = {k: -sum(c / sum(by.values()) * math.log(c / sum(by.values())) for c in by.values()) for k, by in sides.items()}
    got = {r["gram"]: r for r in segment.lexicon_scores(spark.createDataFrame(list(runs.items()), "run string, n long"), min_count=5).collect()}
    assert set(got) == {g for g, n in grams.items() if n >= 5 or len(g) == 1}
    for g, r in got.items():
        assert r["n"] == grams[g]
        assert r["left_entropy"] == pytest.approx(entropy[g, "l"], abs=1e-9) and r["right_entropy"] == pytest.approx(entropy[g, "r"], abs=1e-9)
        if len(g) > 1:
            assert r["cohesion"] == pytest.approx(min(math.log(grams[g] * chars / (grams[g[:i]] * grams[g[i:]])) for i in range(1, len(g))))
        else:
            assert r["cohesion"] is None


def test_best_path_equals_all_paths():
    rng = random.Random(2)
    for _ in range(200):
        grams = {"".join(rng.choices("abc", k=rng.randint(1, 3))): -rng.random() * 5 for _ in range(8)}
        lexicon = segment.Lexicon(grams, -6.0, 3)
        run = "".join(rng.choices("abcd", k=rng.randint(1, 9)))
        best = -math.inf
        for cuts in itertools.product((0, 1), repeat=len(run) - 1):
            pieces, start = [], 0
            for i, c in enumerate([*cuts, 1], 1):
                if c:
                    pieces.append(run[start:i])
                    start = i
            if all(p in grams or len(p) == 1 for p in pieces):
                best = max(best, sum(grams.get(p, -6.0) for p in pieces))
        got = lexicon.cut(run)
        assert "".join(got) == run and sum(grams.get(p, -6.0) for p in got) == pytest.approx(best)


def test_tokens_take_the_words_of_runs(spark):
    rng = random.Random(3)
    words = ["台積電", "漲停", "股價", "外資", "買超", "今天"]
    texts = [(i, "".join(rng.choices(words, k=rng.randint(2, 7))) + "abc def," + rng.choice(words)) for i in range(400)]
    df = spark.createDataFrame([*texts, (900, None), (901, ""), (902, "only latin Words")], "id long, text string")
    got = {r["id"]: r["tokens"] for r in segment.segmented_tokens(df, "text").collect()}
    assert got[902] == ["only", "latin", "words"] and got[901] == [] and not got[900]
    right = total = 0
    for i, t in texts:
        assert got[i][:2] == ["abc", "def"] and "".join(got[i][2:]) in t.replace("abc def,", "")
        total += len(got[i]) - 2
        right += sum(w in words for w in got[i][2:])
    assert right >= 0.95 * total  # the planted words are found again
    plain = df.where("id = 902")
    assert segment.segmented_tokens(plain, "text").first()["tokens"] == ["only", "latin", "words"]
