"""Importance resampling: buckets, gains and ranks against brute force; the tournament against a sort."""

import hashlib
import math
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tallybrook.llm import resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = ["", None, "Ab 12 é中 x_y É " + "q" * 40, "one two  one.TWO", "z" * 30_000 + " tail", " \n", "A" * 24 + "-" + "b" * 25]


def words_of(text):
    return WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def features_of(text, longest):
    w = words_of(text)
    return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


@pytest.mark.parametrize("longest", [1, 3])
@pytest.mark.parametrize("chunk", [16, 1 << 21])
def test_buckets_equal_crc32_of_each_feature(monkeypatch, longest, chunk):
    monkeypatch.setattr(resampling, "CHUNK_BYTES", chunk)
    got, n, words = resampling.buckets_of(pa.array(TEXTS), longest)
    ends = np.cumsum(n)
    for text, b, e, k in zip(TEXTS, ends - n, ends, words, strict=True):
        assert sorted(got[b:e].tolist()) == sorted(bucket(f) for f in features_of(text, longest))
        assert k == len(words_of(text))


def brute(docs, target, percent=10, least=20):
    have, want = {}, {}
    for texts, counts in ((docs.text, have), (target, want)):
        for t in texts:
            for w in words_of(t):
                counts[bucket(w)] = counts.get(bucket(w), 0) + 1
    s, t = sum(have.values()), sum(want.values())
    gain = {b: math.floor(1000 * math.log((want.get(b, 0) + 1) * (s + 10000) / ((have[b] + 1) * (t + 10000)))) for b in have}
    rows = []
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        w = words_of(text)
        weight = sum(gain[bucket(x)] for x in w) // len(w) if w else 0
        h = int(hashlib.sha256(f"2024:{'' if pd.isna(i) else int(i)}".encode()).hexdigest()[:8], 16)
        rows.append([None if pd.isna(i) else int(i), len(w), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    order = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    ranked = [tuple(r) + (k + 1,) for k, r in enumerate(order[: percent * len(order) // 100])]
    rest = [tuple(r) + (None,) for r in rows]
    for r in ranked:
        rest.remove(r[:4] + (None,))
    return ranked + rest


def told(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_draw_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(5, "doc_id")
    target = pd.read_parquet(f"{sf}/benchmark.parquet").text
    assert told(resampling.op11_importance_resampling(spark, sf)) == sorted(brute(docs.toPandas(), target), key=str)


def test_odd_documents_and_ties(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(resampling, "RUN", 7)
    bench = spark.createDataFrame([("the quick words",), (None,)], "text string")
    many = odd_docs
    for _ in range(3):
        many = many.unionAll(many)
    pdf = many.select("doc_id", "text").toPandas()
    for percent in (10, 60, 100):
        got = resampling.drawn(many.repartition(3), bench, percent, least=2)
        assert told(got) == sorted(brute(pdf, ["the quick words", None], percent, 2), key=str)
    assert resampling.drawn(no_docs, bench).count() == 0
    assert resampling.drawn(odd_docs, bench.limit(0)).count() == odd_docs.count()
    assert resampling.drawn(odd_docs, bench, 0).where("rank is not null").count() == 0


def test_tournament_equals_a_sort():
    r = np.random.default_rng(5)
    for n in (1, 2, 3, 7, 16):
        runs = [sorted((int(x), i) for x in r.integers(0, 30, r.integers(0, 40))) for i in range(n)]
        got = [runs[a][b] for a, b in resampling.Tournament(runs)]
        assert got == sorted(x for run in runs for x in run)
    assert list(resampling.Tournament([])) == [] and list(resampling.Tournament([[], []])) == []
