"""Merkle manifest against a plain build, for several arities and block sizes, and odd rows."""

import hashlib
import zlib

import pytest

from tallybrook.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, more=0):
    n = None if r.n_chars is None else r.n_chars + more
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, n, r.text)))


def tree(leaves, arity):
    """Root, and for each leaf what stands before and after it at each level."""
    level, where, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for path, at in zip(paths, where, strict=True):
            a = at - at % arity
            path.append(("".join(level[a:at]), "".join(level[at + 1 : a + arity])))
        level = [sha(*level[a : a + arity]) for a in range(0, len(level), arity)]
        where = [at // arity for at in where]
    return level[0], paths


def brute(rows, arity):
    langs = sorted({r.lang for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    groups = [sorted((r for r in rows if r.lang == v), key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r))) for v in langs]
    built = [tree([leaf(r) for r in g], arity) for g in groups]
    root, above = tree([b[0] for b in built], arity)
    out = []
    for group, (subroot, paths), top in zip(groups, built, above, strict=True):
        for r, path in zip(group, paths, strict=True):
            node = leaf(r, int(r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0))
            for before, after in path + top:
                node = sha(before, node, after)
            out.append((r.doc_id, leaf(r), subroot, root, sha(*(s for p in path + top for s in p)), node, node == root))
    return sorted(out, key=str)


def told(df):
    return sorted((tuple(r)[:7] for r in df.collect()), key=str)


@pytest.mark.parametrize(("arity", "most"), [(2, 4), (2, 4096), (3, 10), (5, 5)])
def test_manifest_equals_a_plain_build(spark, sf, arity, most):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 120")
    assert told(merkle.manifest(docs, arity, most)) == brute(docs.collect(), arity)


def test_whole_table_equals_a_plain_build(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = merkle.op13_merkle_manifest(spark, sf)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert told(got) == brute(docs.collect(), 2) and got.where("not verified").count() > 0


def test_odd_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, odd_docs.repartition(3).unionAll(odd_docs), odd_docs.where("doc_id = 3").limit(1), odd_docs.where("lang is null")):
        rows = docs.collect()
        assert told(merkle.manifest(docs, most=4)) == brute(rows, 2)
    assert merkle.manifest(no_docs).count() == 0


def test_many_languages(spark):
    docs = spark.range(60).selectExpr("id AS doc_id", "concat('t', id) AS text", "if(id % 5 = 0, null, concat('l', id)) AS lang", "'s' AS source", "if(id % 3 = 0, null, id) AS n_chars")
    assert told(merkle.manifest(docs, most=4)) == brute(docs.collect(), 2)


def test_paths_lead_to_the_root(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 40")
    for r in merkle.manifest(docs, 3, 9).collect():
        node = r.leaf
        for p in r.path:
            node = sha(p.before, node, p.after)
        assert node == r.root
