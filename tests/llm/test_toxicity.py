"""Toxic passages: segments against their definition, tokens and odds by hand, held-out labels, odd rows."""

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa

from tallybrook.llm import toxicity

TEXTS = ["You FOOL, you fool!", None, "", "x" * 300 + " " + "x" * 301 + " " + "x" * 300, "é中x éa é", "a\n b\tc", "o'neil 12ab"]


def test_tokens_equal_a_pattern():
    whole, stems, start, length, counts = toxicity.tokens_of(pa.array(TEXTS))
    seen = {}
    for i, text in enumerate(TEXTS):
        raw = (text or "").lower().encode()
        want = [m for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", raw)]
        a, b = counts[i], counts[i + 1]
        assert [(m.start(), len(m[0])) for m in want] == list(zip(start[a:b].tolist(), length[a:b].tolist(), strict=True))
        for m, h, s in zip(want, whole[a:b].tolist(), stems[:, a:b].T.tolist(), strict=True):
            assert seen.setdefault((None, m[0]), h) == h
            for k, v in zip(toxicity.STEMS, s, strict=True):
                assert (v == 0) == (len(m[0]) <= k) and (v == 0 or seen.setdefault((k, m[0][:k]), v) == v)
    assert len(set(seen.values())) == len(seen)


def brute(scores, at=0):
    """The shortest, then first segment of the highest sum, then the same on either side of it."""
    s, _, a, b = max(((sum(scores[a:b]), a - b, -a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0, 0, 0, 0))
    a = -a
    return [] if s <= 0 else [*brute(scores[:a], at), (at + a, at + b, s), *brute(scores[b:], at + b)]


def test_segments_equal_their_definition():
    r = np.random.default_rng(2)
    for n in range(40):
        whole = r.integers(-4, 5, n)
        assert [(a, b, int(s)) for a, b, s in toxicity.segments(whole.astype(float))] == brute(whole.tolist())
        fine = np.round(r.normal(-0.3, 1, n), 3)
        got, want = toxicity.segments(fine), brute(fine.tolist())
        assert [x[:2] for x in got] == [x[:2] for x in want] and np.allclose([x[2] for x in got], [x[2] for x in want])


def test_odds_lean_on_beginnings():
    h = np.array([5, 9, 7, 3], np.uint64)
    parents, level = np.array([0, 5, 9, 0], np.uint64), np.array([0, 1, 2, 0])
    toxic, other = np.array([40.0, 40, 1, 50]), np.array([10.0, 0, 0, 490])
    got = toxicity.odds(h, parents, level, toxic, other, (90.0, 500.0))
    share, c, want, means = 90 / 590, toxicity.PRIOR, [], {}
    for k, p, a, b in zip(h, parents, toxic, other, strict=True):
        mean = means.get(p, share)
        a, b = a + c * mean, b + c * (1 - mean)
        means[k] = a / (a + b)
        value = np.log(a / b) - np.log(share / (1 - share))
        sure = abs(value) >= toxicity.ERRORS * np.sqrt(1 / max(a, 0.5) + 1 / max(b, 0.5))
        want.append(min(max(value, -toxicity.MOST_SCORE), toxicity.MOST_SCORE) if sure else 0)
    assert np.allclose(got, want) and got[1] > got[0] > 0 > got[3]


def test_scores_of_repeats_and_unknown_tokens():
    whole, stems, _, _, counts = toxicity.tokens_of(pa.array(["bad ok bad bad", "bad", "badge"]))
    m = toxicity.Model(np.sort(np.array([whole[0], stems[0, 0]])), np.zeros(2))
    m.scores = np.where(m.hashes == whole[0], 3.0, 1.0)
    assert np.allclose(m.of(whole, stems, counts) + toxicity.DRIFT, [3, 0, 1.5, 1, 3, 1])


def test_law_is_found_again():
    r = np.random.default_rng(4)
    n = r.integers(50, 2000, 20_000)
    best = (np.log(n) + 0.7 + r.gumbel(size=len(n))) / 1.3
    rate, size = toxicity.fitted_law(best, n)
    assert abs(rate - 1.3) < 0.08 and abs(size - 0.7) < 0.4
    a, b = toxicity.fitted_logistic(x := r.normal(size=5000), (r.random(5000) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(float))
    assert abs(a + 1) < 0.2 and abs(b - 2) < 0.2


def test_held_out_labels(spark, sf):
    sf = sf.replace("0.001", "0.01")
    got = toxicity.op12_toxic_segments(spark, sf).toPandas()
    assert all(got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]) and len(got) == len(pd.read_parquet(f"{sf}/documents.parquet"))
    held = got.merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id").query("held_out")
    assert (held.predicted == held.toxic).mean() > 0.93 and held[held.toxic == 0].predicted.mean() < 0.03
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()


def test_passages_are_cut_from_the_texts(spark):
    good, bad = "the river runs by the old mill and the field", "you vile wretch and vile crook"
    rows = [(i, f"{good} {i}. {bad if i % 4 == 0 else good}") for i in range(400)]
    docs = spark.createDataFrame([*rows, (400, None), (400, "É " + good + ": VILE wretch. " + good), (None, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(401, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.scored(docs, model).toPandas()
    assert (got.predicted == [*(int(i % 4 == 0) for i in range(400)), 0, 1, 0]).all()
    found = [r.passage for r in toxicity.passages(docs, model).where("doc_id = 400").collect()]
    assert found == ["vile wretch"]
    one = toxicity.train(docs, labels.where("toxic = 0"))
    assert toxicity.scored(docs, one).where("score >= 0.1").count() == 0
    assert toxicity.train(docs, labels.limit(0)).logistic == (0.0, 0.0)


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(3, 1), (3, 1), (5, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    got = toxicity.scored(odd_docs, model := toxicity.train(odd_docs, labels))
    assert got.count() == odd_docs.count() and got.where("score is null or held_out is null or predicted is null").count() == 0
    assert {r.score for r in got.where("doc_id in (1, 2, 6)").collect()} == {model.score(0.0)}
    assert toxicity.scored(no_docs, model).count() == 0 and toxicity.passages(no_docs, model).count() == 0
    assert toxicity.train(no_docs, labels).logistic == (0.0, 0.0)
