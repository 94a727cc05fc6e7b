"""Tokenised output and packing against the tokenizers library and exact round trips."""

import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallybrook.llm import _encode, packing, repair
from tallybrook.llm._base import new_path, words_of

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["a, b. c, d", "x.", ",", "., a", "1, 2.", "é, a.b, c!.", "A.\nB,\nC", None, "", "  a  b\n\n c ", " \t\n b", "é  x　y  z", "a", "\n", "<|endoftext|> x <|startoftext|>", "a\x01b \x01", "!\x1cb!\x85 \x1c", "É Σας ΣΑΣ don't I'LL 1234 a1b2 中文 ٣٤", "a　\n　b", "a" * 5000, "x.\x85y", "end. "]


@pytest.mark.parametrize("file, end", [(BYTE, 0), (WORD, 2)])
def test_encoder_equals_library(file, end):
    t = Tokenizer.from_file(file)
    ids, off = _encode.Encoder(file, end).encode(pa.array(ODD, pa.string()))
    for i, x in enumerate(ODD):
        assert ids[off[i] : off[i + 1]].tolist() == [*t.encode(x or "", add_special_tokens=False).ids, end]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aB ,.!\n\té1'-中", max_size=30), max_size=4))
def test_encoder_equals_library_on_any_text(texts):
    for file, end in ((BYTE, 0), (WORD, 2)):
        t, e = Tokenizer.from_file(file) if file not in TOKENIZERS else TOKENIZERS[file], _encode.encoder(file, end)
        TOKENIZERS[file] = t
        ids, off = e.encode(pa.array(texts, pa.string()))
        for i, x in enumerate(texts):
            assert ids[off[i] : off[i + 1]].tolist() == [*t.encode(x, add_special_tokens=False).ids, end]


TOKENIZERS: dict = {}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=60), max_size=6), st.integers(1, 4))
def test_repair_round_trip(docs, rules_a_round):
    ids = np.array([i for d in docs for i in d], np.uint32)
    off = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    alphabet, rules, s, at = repair.compress(ids, off, rules_a_round, 2)
    lengths = repair.lengths_of(len(alphabet), rules)
    flat, starts = repair.expansions(alphabet, rules, lengths)
    assert repair.expand(s, flat, starts, lengths).tolist() == ids.tolist()
    for pair in {p for a, b in zip(at[:-1].tolist(), at[1:].tolist()) for p in zip(s[a : b - 1].tolist(), s[a + 1 : b].tolist())}:  # no pair is left that stands twice without overlap
        text = [" ".join(map(str, s[a:b].tolist())) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        assert sum(len(re.findall(rf"(?<!\S){pair[0]} {pair[1]}(?!\S)", t)) for t in text) < 2
    row = {"width": 4, "doc_ids": np.arange(len(docs)).astype(np.int64).tobytes(), "doc_nulls": np.zeros(len(docs), bool).tobytes(), "doc_symbols": at.astype(np.int64).tobytes(), "doc_tokens": off.tobytes(), "alphabet": alphabet.astype(np.uint32).tobytes(), "rules": rules.astype(np.uint32).tobytes(), "lengths": lengths[len(alphabet) :].astype(np.uint32).tobytes(), "symbols": s.astype(np.uint32).tobytes()}
    shard = repair.Shard(row)
    for i, d in enumerate(docs):
        assert shard.tokens(i) == d and shard.tokens(i, 2, 7) == d[2:7]


def test_repair_makes_rules():
    ids = np.array([1, 2, 3, 4] * 500, np.uint32)
    _, rules, s, _ = repair.compress(ids, np.array([0, 2000]))
    assert len(rules) and len(s) <= 20
    _, rules, s, _ = repair.compress(np.zeros(4096, np.uint32), np.array([0, 4096]))
    assert len(s) <= 20


def test_words_of_one_hash_are_told_apart(monkeypatch):
    texts = ["some other words", "words of some other kind", "kind", "some, words."]
    for file, end in ((BYTE, 0), (WORD, 2)):
        want, t = _encode.Encoder(file, end), Tokenizer.from_file(file)
        monkeypatch.setattr(_encode, "words_of", lambda *a, own=words_of: (own(*a)[0] & np.uint64(4), *own(*a)[1:]))
        ids, off = want.encode(pa.array(texts))
        for i, x in enumerate(texts):
            assert ids[off[i] : off[i + 1]].tolist() == [*t.encode(x, add_special_tokens=False).ids, end]
        monkeypatch.undo()


def test_shards_of_odd_documents(spark, odd_docs, no_docs):
    path = new_path(spark, "t")
    repair.write_shards(odd_docs, path, BYTE, 0, shard_tokens=20)
    got = sorted(map(tuple, repair.read_documents(spark, path).collect()), key=lambda r: r[1])
    t, at = Tokenizer.from_file(BYTE), 0
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""), r.doc_id, r.text) for r in odd_docs.collect())
    assert [g[0] for g in got] == [r[1] for r in rows]
    for g, (_, doc, text) in zip(got, rows, strict=True):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], np.uint32)
        assert g == (doc, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    path = new_path(spark, "t")
    repair.write_shards(no_docs, path, BYTE, 0)
    assert repair.read_documents(spark, path).count() == 0


def test_packing_of_odd_documents(spark, odd_docs, no_docs):
    got = packing.pack(odd_docs, WORD, 2, 64, 100).toPandas()
    t = Tokenizer.from_file(WORD)
    want = {r.doc_id: np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 2], np.uint32) for r in odd_docs.collect() if r.doc_id is not None}
    for r in got.dropna().itertuples():
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[int(r.start) : int(r.start + r.length)].tobytes())
    sums = got.groupby("doc_id").length.sum()
    assert all(sums[d] == len(i) * (2 if d == 3 else 1) for d, i in want.items())
    s = got.sort_values(["sequence_id", "offset"])
    assert (s.offset == s.groupby("sequence_id").length.cumsum() - s.length).all()
    full = s.groupby("sequence_id").length.sum()
    assert all(n == 64 or n & (n - 1) == 0 for n in full) and full.max() == 64
    assert packing.pack(no_docs, WORD, 2).count() == 0


def test_assign_prefers_cheap_sequences():
    pieces = packing.assign(np.array([60, 60, 30, 30, 4, 4, 4]), 64)
    cut = len({(d, k) for d, _, _, k, _ in pieces}) - 7
    assert sum(p[2] for p in pieces) == 192 and cut <= 2


def test_costs_are_more_even_than_those_of_first_fit():
    sizes = np.random.default_rng(7).integers(1, 900, 400)
    cost = lambda n: packing.LINEAR * n + packing.QUADRATIC * n * n
    ours, used = {}, []
    for _, _, n, seq, _ in packing.assign(sizes, 1024):
        ours[seq] = ours.get(seq, 0) + cost(n)
    for n in sizes.tolist():  # as they come, into the first with room
        k = next((i for i, (room, _) in enumerate(used) if room >= n), None)
        if k is None:
            used.append((1024 - n, cost(n)))
        else:
            used[k] = used[k][0] - n, used[k][1] + cost(n)
    full = sorted(ours.values())[len(ours) // 10 :]  # without the short sequences at a group's end
    assert max(full) - min(full) < max(c for _, c in used) - min(c for _, c in used)


@pytest.mark.parametrize("length", [16, 64])
def test_assign_equals_a_plain_search(length):
    """Longest rest first, each to the cheapest sequence with room for it, else cut into the one with most room."""
    r = np.random.default_rng(length)
    for n in (0, 1, 2, 9, 60):
        sizes = r.integers(0, 3 * length, n)
        out, seq, rests = [], 0, []
        for doc, size in enumerate(sizes):
            for k in range(size // length):
                out.append((doc, k * length, length, seq, 0))
                seq += 1
            if size % length:
                rests.append((size % length, doc))
        total = sum(x for x, _ in rests)
        rooms = [length] * (total // length) + [2**b for b in range(10, -1, -1) if (total % length) // 2**b % 2]
        held = [[] for _ in rooms]
        for size, doc in sorted(rests, key=lambda x: (-x[0], x[1])):
            start = sizes[doc] - size
            while size:
                cost = lambda k: sum(packing.LINEAR * x + packing.QUADRATIC * x * x for x in held[k])
                free = lambda k: rooms[k] - sum(held[k])
                able = [k for k in range(len(rooms)) if free(k) >= size]
                k = min(able, key=lambda k: (cost(k), k)) if able else max(range(len(rooms)), key=lambda k: (free(k), -k))
                part = min(size, free(k))
                out.append((doc, start, part, seq + k, sum(held[k])))
                held[k].append(part)
                size, start = size - part, start + part
        assert packing.assign(sizes, length) == out
