"""Searches, joins, rules and mixing against brute force, and defined results on odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybrook.llm import bitslice, chosen_path, mixing, pq_dedup, url_rules
from tallybrook.llm._components import components, roots


def test_components(spark):
    r = np.random.default_rng(2)
    edges = [tuple(map(int, r.integers(0, 300, 2))) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {x.id: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    low = {i: i for e in edges for i in e}
    for _ in range(400):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    linked = {i for a, b in edges if a != b for i in (a, b)}
    assert got == {i: low[i] for i in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 16)).astype("float32")
    x[200:260] = x[0] + r.normal(size=(60, 16)) * 0.05
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(900, None, 1), (901, [float("nan")] * 16, 1), (902, [None] + [1.0] * 15, 1), (903, [0.0] * 16, 1), (904, [1.0, 2.0], 1), (905, [1.0, 2.0], 1), (906, [], 1), (907, [float("inf")] * 16, 1)]
    return x, spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")


def test_bit_sliced_top_k(spark, monkeypatch):
    x, df = vectors(spark)
    monkeypatch.setattr(bitslice, "BLOCK_ROWS", 70)
    monkeypatch.setattr(bitslice, "BLOCK_QUERIES", 3)
    got = {tuple(r) for r in bitslice.top_k(df, F.col("vec_id") % 20 == 0).collect()}
    v, want = np.floor(256 * x.astype(float)).astype(int), set()
    for i in range(0, 300, 20):
        s = v @ v[i]
        order = [j for j in np.lexsort((np.arange(300), -s)) if j != i][:5]
        want |= {(i, k + 1, int(j), int(s[j])) for k, j in enumerate(order)}
    assert {g for g in got if g[0] < 900} == want
    assert bitslice.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    ties = spark.createDataFrame([(i, [1.0, -1.0]) for i in (0, 7, 7, 3, 9, 8, 5)], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in bitslice.top_k(ties, F.col("vec_id") == 0).orderBy("rank").collect()] == [3, 5, 7, 7, 8]


def test_bit_sliced_top_k_broadcasts_no_packs(spark, sf, monkeypatch):
    monkeypatch.setattr(bitslice, "BLOCK_ROWS", 20)
    got = bitslice.top_k(spark.read.parquet(f"{sf}/embeddings.parquet"), F.col("vec_id") % 50 == 0)
    assert len(got.collect()) == 50
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan


def test_bit_sliced_block_leaves_low_products_out(monkeypatch):
    r, cuts, sums = np.random.default_rng(4), [], bitslice.score_slices
    v = np.floor(r.normal(size=(1500, 16)) * 60).astype(int)
    v[700:720] = v[7]
    ids = np.arange(1500) * 2
    planes, low, _ = bitslice.slices_of(v)
    block = bitslice.Block(planes, low, ids)
    monkeypatch.setattr(bitslice, "score_slices", lambda planes, parts, cut=0: cuts.append(cut) or sums(planes, parts, cut))
    for left_out, whole in ((0.0, True), (1.0, False), (50.0, True)):
        monkeypatch.setattr(bitslice, "LEFT_OUT", left_out)
        cuts.clear()
        for q in range(0, 1500, 100):
            s = v @ v[q]
            want = [(int(ids[i]), int(s[i])) for i in np.lexsort((ids, -s)) if i != q][:5]
            assert sorted(block.search(int(ids[q]), v[q], 5), key=lambda x: (-x[1], x[0])) == want
        assert (0 in cuts) == whole and (max(cuts) > 0) == (left_out > 0)
    numbers = [r.normal(size=40) * size for size in (1, 100, 1e6, 1e12, 1e30)]
    assert [bitslice.narrowed(np.floor(x)).tolist() for x in numbers] == [np.floor(x).tolist() for x in numbers]
    assert [bitslice.narrowed(np.floor(x)).itemsize for x in numbers] == [1, 2, 4, 8, 8]


def test_pq_dedup(spark, monkeypatch):
    x, df = vectors(spark)
    monkeypatch.setattr(pq_dedup, "CELL_ROWS", 40)
    monkeypatch.setattr(pq_dedup, "BLOCK", 16)
    monkeypatch.setattr(pq_dedup, "VISITORS", 32)
    rows = pq_dedup.near_duplicates(df.unionByName(df.where("vec_id = 5"))).collect()
    got = {r.vec_id: r for r in rows}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    n = (u @ u.T >= 0.9).sum(1) - 1
    n[5] += 1
    assert len(rows) == 309 and [got[i].n_links for i in range(300)] == n.tolist()
    assert [(r.n_links, r.component_id, r.kept) for r in rows if r.vec_id == 5] == [(1, 5, True)] * 2
    assert got[230].component_id == 0 and not got[230].kept and got[0].kept
    assert got[904].n_links == 1 and got[905].component_id == 904 and all(got[i].n_links == 0 and got[i].kept for i in (900, 901, 902, 903, 906, 907))
    assert pq_dedup.near_duplicates(df.limit(0)).count() == 0


def test_bit_sliced_top_k_of_large_components(spark, monkeypatch):
    monkeypatch.setattr(bitslice, "WIDE_ROWS", 4)
    r = np.random.default_rng(9)
    x = [[3e6, 1.0], [1.0, 1.0], [2.0, 1.0], [-5e5, 2.0], [2e6, 0.5]] + [(r.normal(size=2) * 10.0 ** r.integers(-3, 160)).tolist() for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    got = sorted(tuple(v) for v in bitslice.top_k(df, F.col("vec_id") % 5 == 0, 7).collect())
    whole, want = [[math.floor(256 * c) for c in v] for v in x], []
    for q in range(0, len(x), 5):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in enumerate(whole) if i != q)[:7]
        want += [(q, k + 1, i, max(-(2**63), min(2**63 - 1, -s))) for k, (s, i) in enumerate(scores)]
    assert got == want and {0, 4} <= {g[2] for g in got} | {g[0] for g in got}


def test_pq_dedup_of_equal_ids_and_extreme_lengths(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (7, [2.0, 0.1]), (8, [1e200, 0.0]), (9, [0.0, 1e-200]), (3, [0.0, 5e-324]), (4, [-1.0, -1.0]), (None, [-2.0, -2.0]), (None, [1.0, -1.0]), (6, [1e308, -1e308])]
    got = pq_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in got) == sorted([(1, 2, 1, True), (1, 2, 1, True), (7, 2, 1, False), (8, 2, 1, False), (9, 2, 1, False), (3, 2, 1, False), (4, 1, 4, True), (0, 1, 4, False), (0, 1, 6, False), (6, 1, 6, True)])


def test_pq_dedup_finds_every_pair_of_a_decaying_spectrum(spark, monkeypatch):
    r = np.random.default_rng(8)
    spread = np.arange(1, 65) ** -1.5
    x = r.normal(size=(1000, 64)) * spread
    x /= np.linalg.norm(x, axis=1)[:, None]
    off = r.normal(size=(1000, 64)) * spread
    off -= (off * x).sum(1)[:, None] * x
    x = np.concatenate([x, 0.91 * x + np.sqrt(1 - 0.91**2) * off / np.linalg.norm(off, axis=1)[:, None]])
    n = (x @ x.T >= 0.9).sum(1) - 1
    monkeypatch.setattr(pq_dedup, "CELL_ROWS", 20)
    got = {v.vec_id: v for v in pq_dedup.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    assert n.sum() > 2000 and [got[i].n_links for i in range(len(x))] == n.tolist()
    a, b = np.nonzero(x @ x.T >= 0.9)
    assert [got[i].component_id for i in range(len(x))] == roots(len(x), a, b).tolist()


def brute(texts):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    return [[j for j, b in enumerate(sets) if i != j and a and len(a & b) / len(a | b) >= 0.8] for i, a in enumerate(sets)]


def judged(ids, texts):
    """Links and the smallest id of the component of each row, by brute force."""
    want, low = brute(texts), list(ids)
    for _ in range(len(texts)):
        for i, w in enumerate(want):
            low[i] = min([low[i], *(low[j] for j in w)])
    return [len(w) for w in want], low


def near_copies(r):
    words = [f"w{i}" for i in range(500)]
    texts = [" ".join(r.choice(words, r.integers(1, 80))) for _ in range(60)]
    base_text = r.choice(words, 120).tolist()
    for _ in range(90):  # a group larger than a block
        w = list(base_text)
        for i in r.integers(0, 120, 1):
            w[i] = str(r.choice(words))
        texts.append(" ".join(w))
    return texts + [texts[0], texts[0].upper(), "one two", "ONE  two", "", None]


def test_chosen_path_equals_brute_force(spark, monkeypatch):
    texts = near_copies(np.random.default_rng(4))
    monkeypatch.setattr(chosen_path, "BLOCK", 20)
    monkeypatch.setattr(chosen_path, "SMALL_BUCKET", 8)
    got = chosen_path.join(spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, id int")).toPandas().set_index("doc_id")
    links, low = judged(range(len(texts)), texts)
    assert [got.n_links[i] for i in range(len(texts))] == links
    assert [got.class_id[i] for i in range(len(texts))] == low


def test_chosen_path_with_hubs_that_are_unlike_their_buckets(spark, monkeypatch):
    texts = near_copies(np.random.default_rng(5))
    for name, value in {"BLOCK": 20, "SMALL_BUCKET": 2, "SKETCH_BLOCK": 7, "SKETCH_BITS": 26, "BLOCK_SHINGLES": 900}.items():
        monkeypatch.setattr(chosen_path, name, value)
    monkeypatch.setattr(chosen_path, "differ", lambda a, b, own=chosen_path.differ: own(a, b) + (F.lit(100) if b == "h" else F.lit(0)))  # no hub is like any
    got = chosen_path.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).toPandas().set_index("doc_id")
    links, low = judged(range(len(texts)), texts)
    assert [got.n_links[i] for i in range(len(texts))] == links and [got.class_id[i] for i in range(len(texts))] == low


def test_chosen_path_of_equal_ids_with_different_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    ids, texts = [1, 1, 2, 3, 4, 0, 1], [a, b, a + " x", b + " y", b + " z", a + " w", a]
    df = spark.createDataFrame([*zip(ids, texts), (None, a + " x"), (None, "alone here"), (None, "alone here"), (None, None), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in chosen_path.join(df.where("doc_id is not null")).collect())
    links, low = judged(ids, texts)
    assert got == sorted(zip(ids, low, links))
    every = [(r.doc_id, r.class_id, r.n_links) for r in chosen_path.join(df).collect()]
    assert len(every) == 12 and (None, 0, 4) in every and every.count((None, None, 1)) == 2 and every.count((None, None, 0)) == 2
    left = [(r.doc_id, r.text) for r in chosen_path.one_of_each(df).collect()]
    assert sorted(left, key=str) == sorted([(0, a + " w"), (1, b), (None, "alone here"), (None, None), (None, None)], key=str)


def test_chosen_path_of_odd_documents(spark, odd_docs, no_docs):
    got = chosen_path.join(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert sorted(r.n_links for r in got if r.doc_id == 3) == [1, 1] or all(r.n_links >= 1 for r in got if r.doc_id == 3)
    left = chosen_path.one_of_each(odd_docs)
    assert left.columns == odd_docs.columns and sorted(r.doc_id for r in left.collect() if r.doc_id is not None).count(3) == 1
    assert left.where("doc_id is null").count() == 1 and left.where("doc_id in (1, 2, 6)").count() == 3
    assert chosen_path.join(no_docs).count() == 0 and chosen_path.one_of_each(no_docs).count() == 0


def test_meeting_chance():
    runs = chosen_path.runs_for(0.999, 4)
    assert (1 - chosen_path.meeting(4, 0.8, 0.8)) ** runs <= 0.001


@pytest.mark.parametrize("shapes", [0, 8])
def test_url_rules(spark, monkeypatch, shapes):
    monkeypatch.setattr(url_rules, "MOST_SHAPES", shapes)  # by distinct urls, and in the pages' rows
    urls = ["http://A.Example.ORG/en/12?x", "https://org", "ftp://x.org/", "http://example.org/es/", "http://notexample.org/es/", "nothing", None, "", "http://m.com/fr/1#a", "http://m.com/de/1", "http://x.net/fr/", "http://x.org?y=http://a.com/de/", "http://" + "a." * 3000 + "com/de/", "http://ÉX.org/é"]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)] + [(0, urls[0], 1)], "page_id long, url string, rule int")
    got = url_rules.judge(pages, url_rules.rule_table(spark, url_rules.RULES)).collect()
    by = {r.page_id: (r.rule, r.verdict) for r in got}
    assert len(got) == len(urls) + 1
    assert by[0] == ("example.org/en/1", "block") and by[1] == (None, "allow") and by[2] == ("org/", "allow") and by[3] == ("example.org/es/", "block") and by[4] == ("org/", "allow")
    assert by[5] == by[6] == by[7] == by[10] == by[11] == (None, "allow") and by[8] == ("com/fr/", "allow") and by[9] == by[12] == ("com/de/", "block")
    first = next(r for r in got if r.page_id == 0)
    assert (first.host, first.path) == ("a.example.org", "/en/12") and next(r.host for r in got if r.page_id == 13) == "Éx.org"
    assert url_rules.judge(pages.limit(0), url_rules.rule_table(spark, url_rules.RULES)).count() == 0
    assert url_rules.judge(pages, url_rules.rule_table(spark, url_rules.RULES).limit(0)).where("verdict <> 'allow'").count() == 0


def test_pfair_schedule_keeps_within_a_block():
    r = np.random.default_rng(5)
    for _ in range(30):
        given = mixing.slots_of({f"s{i}": float(w) for i, w in enumerate(r.random(r.integers(1, 12)) ** 3)}, 100)
        total, seen = sum(given.values()), dict.fromkeys(given, 0)
        for slot, (s, k, at) in enumerate(mixing.schedule(given)):
            assert at == slot and k == seen[s]
            seen[s] += 1
            assert all(abs(seen[x] - given[x] * (slot + 1) / total) < 1 for x in given)
        assert seen == given


def test_sources_beyond_the_list_are_scheduled_in_pools(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 2)
    size = {"s0": 400, "s1": 300, **{f"t{i}": 60 for i in range(7)}, **{f"u{i}": 25 for i in range(3)}, "v": 9}
    rows = [(i, s, "x" * 50) for i, s in enumerate(s for s, n in size.items() for _ in range(n))]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, source string, text string"), block_chars=500).toPandas()
    assert sorted(got.doc_id) == list(range(len(rows))) and (got.mix_source == got.source).all()
    for _, own in got.groupby("source"):
        own = own.sort_values("mix_start")
        assert (own.mix_start == np.arange(len(own)) * 50).all() and (own.mix_block == own.mix_start // 500).all() and own.mix_slot.is_monotonic_increasing
    first = got.groupby("mix_slot").source.nunique()
    assert (first == 1).all()  # no slot serves two sources
    weight = {s: float(n * 50) ** mixing.POWER for s, n in size.items()}
    shares = mixing.slots_of({**{s: weight[s] for s in ("s0", "s1")}, "t": 7 * weight["t0"], "u": 3 * weight["u0"], "v": weight["v"]})
    part = {s: shares.get(s, shares[s[0]] / {"t": 7, "u": 3, "v": 1}[s[0]] if s[0] in "tuv" else 0) / sum(shares.values()) for s in size}
    blocks = got.groupby(["source", "mix_block"]).mix_slot.first()
    horizon = got[got.mix_on_target].mix_slot.max()
    for s in size:
        own = np.sort(blocks[s].to_numpy())
        for t in range(1, int(horizon) + 1):  # a block and, in a pool, a turn
            assert abs((own < t).sum() - part[s] * t) < (1 if s in ("s0", "s1", "v") else 2), (s, t)


def test_mixing(spark, odd_docs, no_docs):
    r = np.random.default_rng(6)
    rows = [(i, str(r.choice(["a", "b", "c"], p=[0.7, 0.2, 0.1])), "x" * int(r.integers(1, 90))) for i in range(1500)]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, source string, text string"), block_chars=500).toPandas()
    assert sorted(got.doc_id) == list(range(1500))
    for s, own in got.groupby("mix_source"):
        own = own.sort_values("mix_start")
        size = own.text.str.len()
        assert (own.mix_start == size.cumsum() - size).all() and (own.mix_block == own.mix_start // 500).all() and own.mix_slot.is_monotonic_increasing
    slots = got[got.mix_on_target].groupby("mix_slot").mix_source.nunique()
    assert (slots == 1).all() and len(slots) > 10
    tiny = mixing.mixed(spark.createDataFrame([*rows, (5000, "tiny", "x")], "doc_id long, source string, text string"), block_chars=500).toPandas()
    assert tiny[tiny.mix_on_target].mix_slot.nunique() > 10  # a source of one block takes nothing from the others
    long = mixing.mixed(spark.createDataFrame([(i, "ab"[i % 2], "x" * 1700) for i in range(40)] + [(None, "a", "y")] * 5, "doc_id long, source string, text string"), block_chars=500).toPandas()
    assert len(long) == 45 and (long.mix_block == long.mix_start // 500).all()  # documents longer than a block begin in their own
    out = mixing.reordered(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count() and out.where("mix_slot = 5").count() == odd_docs.count()
    assert mixing.reordered(no_docs).count() == 0


def test_groups_of_components_hold_few_shingles(spark, monkeypatch):
    """Pairs of long texts are dealt to groups by what they hold, not by how many they are."""
    monkeypatch.setattr(chosen_path, "GROUP_SHINGLES", 4000)
    r = np.random.default_rng(8)
    texts = [" ".join(f"w{x}" for x in r.integers(0, 10**6, 1000)) for _ in range(20)]
    docs = spark.createDataFrame([(2 * i + k, t + " end" * k) for i, t in enumerate(texts) for k in (0, 1)], "doc_id long, text string")
    got = {x.doc_id: (x.class_id, x.n_links) for x in chosen_path.join(docs).collect()}
    assert got == {i: (i - i % 2, 1) for i in range(40)}


def test_mixed_rows_equal_a_plain_schedule(spark):
    """Block by block: releases and deadlines from the weights, the earliest deadline of what may run, slot by slot."""
    r = np.random.default_rng(3)
    rows = [(i, str(r.choice(["a", "b", "c"], p=[0.6, 0.3, 0.1])), "x" * int(r.integers(1, 200))) for i in range(700)]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, source string, text string"), block_chars=700).toPandas()
    chars = got.assign(n=got.text.str.len()).groupby("source").n.sum()
    given = mixing.slots_of({s: float(n) ** mixing.POWER for s, n in chars.items()})
    total, last = sum(given.values()), got.groupby("source").mix_block.max()
    waiting, slot_of = {s: 0 for s in given}, {}
    for slot in range(3 * total):
        free = [(-(-(k + 1) * total // given[s]), s, k) for s, k in waiting.items() if k * total // given[s] <= slot]
        _, s, k = min(free)
        slot_of[s, k] = slot
        waiting[s] = k + 1
    assert all(last[s] < waiting[s] for s in given)
    assert [slot_of[s, k] for s, k in zip(got.source, got.mix_block, strict=True)] == got.mix_slot.tolist()
