"""Best fuzzy entries and nearest passages against scoring everything."""

import random

import numpy as np
import pytest

from tallybrook.operators import fuzzy, passages


def test_best_equals_scoring_all_pairs(spark):
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcé") for _ in range(r.choice([1, 2, 2, 3, 5, 9])))
    line = lambda: " ".join(word() for _ in range(r.choice([0, 1, 1, 2, 3, 5])))
    names = list(dict.fromkeys([line() for _ in range(150)] + ["ab", "axb", "a b", "  ab\tc  ", "x" * 200]))
    texts = [line() for _ in range(150)] + names[::3] + ["ab", "acb", "", "ab c", "x" * 180 + "y" * 20, None]
    for i in range(0, 100, 2):  # near copies
        t = list(r.choice(names) or "q")
        t[r.randrange(len(t))] = r.choice("abz ")
        texts.append("".join(t))
    corpus = spark.createDataFrame([(n, i) for i, n in enumerate(names)] + [(names[5], 900), (None, 3)], "name string, seq int")
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {x.id: (x.name, x.confidence) for x in fuzzy.best(df, corpus, "id", "text", "name", "seq").collect()}
    want = {}
    for i, t in enumerate(texts):
        score, at = max(((fuzzy.token_set_ratio(t, n), -k) for k, n in enumerate(names)), default=(0, 0)) if t is not None else (0, 0)
        if score >= 78:
            want[i] = (names[-at], pytest.approx(round(score / 100, 3), abs=1e-9))
    assert got == want and len(want) > 60
    rows = fuzzy.scored(df.where("text is not null"), corpus, "text", "name", "seq").collect()
    assert all(x.score <= x.bound + 1e-9 for x in rows) and len(rows) < 0.2 * len(set(texts)) * len(names)
    with pytest.raises(ValueError):
        fuzzy.best(df, corpus, "id", "text", "name", "seq", 50.0)


def test_fuzzy_of_empty_tables(spark):
    df = spark.createDataFrame([(1, "a")], "id int, text string")
    corpus = spark.createDataFrame([("a", 1)], "name string, seq int")
    assert fuzzy.best(df.limit(0), corpus, "id", "text", "name", "seq").count() == 0
    assert fuzzy.best(df, corpus.limit(0), "id", "text", "name", "seq").count() == 0


@pytest.mark.parametrize("block", [1024, 7])
def test_nearest_of_many_passages(spark, monkeypatch, block):
    monkeypatch.setattr(passages, "BLOCK", block)
    r = np.random.default_rng(1)
    x, y = np.round(r.normal(size=(60, 5)), 2), np.round(r.normal(size=(40 if block == 7 else 6000, 5)), 2)
    y[3] = y[9]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(98, None), (99, [1.0, None, 1.0, 1.0, 1.0])], "id int, v array<double>").repartition(3)
    known = spark.createDataFrame([(f"p{i:05d}", v.tolist()) for i, v in enumerate(y)], "label string, v array<double>")
    got = {a.id: (a.label, a.confidence) for a in passages.nearest(vectors, known, "id", "v", "label", 0.5).collect()}
    scores = np.round(x @ y.T, 12)
    want = {}
    for i, s in enumerate(scores):
        j = max(np.flatnonzero(s == s.max()))
        if round(s[j], 4) >= 0.5:
            want[i] = (f"p{j:05d}", pytest.approx(s[j], abs=6e-5))
    assert got == want
    assert passages.nearest(vectors, known.limit(0), "id", "v", "label", 0.0).count() == 0
    assert "CartesianProduct" not in passages.nearest(vectors, known, "id", "v", "label", 0.5)._jdf.queryExecution().toString()
