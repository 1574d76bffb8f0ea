"""Chosen grams and their weights against counting all of them."""

import random

from tessella.operators import grams, models


def test_only_grams_that_can_be_chosen_are_counted(spark, monkeypatch):
    rng = random.Random(3)
    words = ["the", "of", *(f"w{i}" for i in range(30))]
    docs = [(d // 2 if d < 40 else d, " ".join(rng.choices(words, [30, 20, *(30 / (i + 1) for i in range(30))], k=rng.randint(0, 60)))) for d in range(160)]
    docs += [(1000, None), (1001, ""), (None, "the of w1 w1 w2"), (1002, "W1-of, The é w2")] + [(2000 + i, f"once{i} one{i} two{i}") for i in range(50)]
    df = spark.createDataFrame(docs, "k long, t string")
    seen, longer = [], grams._longer
    monkeypatch.setattr(grams, "_longer", lambda *a: (lambda r: (seen.append(r.count()), r)[1])(longer(*a)))
    every = models.word_grams(df, "k", "t").distinct().count()
    for features in (25, 120, 7500):
        seen.clear()
        got = {(r["k"], r["term"]): r["weight"] for r in grams.weights(df, "k", "t", len(docs), features=features).collect()}
        want = {(r["k"], r["term"]): r["weight"] for r in models.tf_idf(models.word_grams(df, "k", "t"), "k", len(docs), features=features).collect()}
        assert got.keys() == want.keys() and len({t for _, t in want}) <= features
        assert all(abs(got[key] - want[key]) < 1e-12 for key in want)
        assert sum(seen) < (every if features == 7500 else every // 4)
