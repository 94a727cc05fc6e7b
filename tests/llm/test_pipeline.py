"""The pipeline's stages on their own inputs."""

import pandas as pd

import corpus_pipeline
from tallybrook.llm import queries
from tallybrook.llm._base import stored


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf), "stage")
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == columns, name
    assert counts[0] > counts[1] > counts[2] == counts[3] == counts[4]
    assert set(docs.columns) >= {"doc_id", "start", "length", "sequence_id", "offset"}


def test_run_equals_its_stages(spark, sf):
    out = corpus_pipeline.run(spark, sf).toPandas()
    assert len(out) and (out.groupby("sequence_id").length.sum() <= 4096).all()
    labels = pd.read_parquet(f"{sf}/labels.parquet")
    assert len(set(out.doc_id) & set(labels.doc_id[labels.quality == 0])) < 0.2 * (labels.quality == 0).sum()


def test_sequences_follow_the_mix(spark, sf):
    text = "one two three four five six seven eight nine ten " * 100
    of = ["a"] * 2400 + ["b"] * 600 + ["c"] * 600  # a source of two thirds, stored ahead of the others; alone at the mix's end, but for a group's part
    docs = spark.createDataFrame([(i, text, s) for i, s in enumerate(of)], "doc_id long, text string, source string")
    docs = stored(docs.coalesce(1).sortWithinPartitions("doc_id"), "sources")
    got = corpus_pipeline.pack(spark, docs, sf).toPandas().sort_values(["sequence_id", "offset"])
    got["source"] = [of[i] for i in got.doc_id]
    assert sorted(set(got.doc_id)) == list(range(len(of)))
    at, total = got.length.cumsum(), got.length.sum()
    head, tail = got[at <= 0.6 * total], got[at > 0.9 * total]
    shares = head.groupby("source").length.sum() / head.length.sum()
    weights = {"a": 2400**0.7, "b": 600**0.7, "c": 600**0.7}
    assert all(abs(shares[s] - w / sum(weights.values())) < 0.04 for s, w in weights.items())
    assert tail.length[tail.source == "a"].sum() > 0.85 * tail.length.sum()


def test_stages_of_odd_documents_and_of_none(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([(3, 1, 0), (5, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_docs, no_docs):
        columns, n = docs.columns, docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, str(tmp_path)), "stage")
            assert name == "packing" or docs.columns == columns, name
            assert name == "packing" or docs.count() <= n
        assert (docs.count() > 0) == (n > 0)


def test_names():
    assert sorted(n.split("_")[0] for n in queries.QUERIES) == sorted(f"op{i}" for i in range(1, 14))
