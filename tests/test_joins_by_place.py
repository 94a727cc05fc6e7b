"""Range joins and the automaton against brute force."""

import random
import re

import pytest

from tallybrook.operators import automaton, intervals, linkage


def pairs(rows, others, keyed):
    return sorted((x[0], y[0]) for x in rows for y in others if x[1] <= x[2] and y[1] <= y[2] and x[1] <= y[2] and y[1] <= x[2] and (not keyed or x[3] == y[3]))


@pytest.mark.parametrize("keyed", [False, True])
def test_overlapping_equals_brute_force(spark, keyed):
    r = random.Random(3)
    longest = [0, 3, 15, 16, 64, 900, 70_000, 10**9]
    make = lambda n, seed: [(i, a := r.randint(-3000, 3000), a + r.randint(-1, r.choice(longest)), r.randint(0, 2)) for i in range(n)]
    x, y = make(90, 1), make(110, 2)
    left, right = spark.createDataFrame(x, "i int, a long, b long, k int"), spark.createDataFrame(y, "j int, c long, d long, k int")
    if not keyed:
        left, right = left.drop("k"), right.drop("k")
    got = intervals.overlapping(left, right, ("a", "b"), ("c", "d"), ["k"] if keyed else None)
    assert sorted((r.i, r.j) for r in got.collect()) == pairs(x, y, keyed)
    assert "NestedLoop" not in got._jdf.queryExecution().toString()


def test_nulls_points_and_empty_sides(spark):
    left = spark.createDataFrame([(1, 5, 5), (2, None, 9), (3, 9, None), (4, 8, 5)], "i int, a int, b int")
    right = spark.createDataFrame([(1, 5), (2, 5), (3, 6), (4, None)], "j int, c int")
    assert sorted((r.i, r.j) for r in intervals.overlapping(left, right, ("a", "b"), ("c", "c")).collect()) == [(1, 1), (1, 2)]
    assert intervals.overlapping(left.limit(0), right, ("a", "b"), ("c", "c")).count() == 0
    assert sorted((r.j, r.n) for r in intervals.counted(right, left, "c", ("a", "b"), "n").collect()) == [(1, 1), (2, 1), (3, 0), (4, 0)]


def test_intervals_are_not_copied_beyond_their_visitors(spark):
    o = spark.range(2000).selectExpr("id % 500 as k", "id as x", "id as a", "id + 90 as b")  # small enough to be sent whole
    got = intervals.overlapping(o, o.selectExpr("k", "x as y", "a as p"), ("a", "b"), ("p", "p"), ["k"])
    assert got.count() == 2000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan


TEXTS = ["護衛艦の修理", "ss-1 SS 12SS", "", None, "abcabc" * 5000 + "needle in the haystack" + "z" * 1000, "eneedle éneedle", "x" * 30 + "y", "x" * 31]
WORDS = ["艦", "護衛艦", "SS", "", "needle", "needle in the haystack", "abc", "x" * 24, "x" * 30 + "y", "x" * 29 + "z", None, "修理"]


def within(text, word, edge):
    return any(not edge or m.start() == 0 or not re.match("[A-Za-z0-9]", text[m.start() - 1]) for m in re.finditer(f"(?={re.escape(word)})", text))


@pytest.mark.parametrize("octets", [1 << 24, 40])
def test_hits_equal_brute_force(spark, monkeypatch, octets):
    monkeypatch.setattr(automaton, "MOST_OCTETS", octets)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").repartition(3)
    words = spark.createDataFrame([(w, bool(w) and w.isascii()) for w in [*WORDS, "艦"]], "w string, edge boolean")
    for bounded in (None, "edge"):
        got = sorted((r.id, r.w) for r in automaton.hits(docs, "text", words, "w", bounded, ["id"]).collect())
        assert got == sorted((i, w) for i, t in enumerate(TEXTS) for w in WORDS if t and w and within(t, w, bounded and w.isascii()))
    assert automaton.hits(docs, "text", words.limit(0), "w").count() == 0


def test_dictionary_of_one_character_and_stop_list(spark):
    docs = spark.createDataFrame([(1, "護衛艦 SS"), (2, "F-15 xF-15"), (3, "xF-15"), (1, "護衛艦")], "id int, t string")
    known = spark.createDataFrame([(1, "艦", 1.0), (2, "護衛艦", 0.9), (2, "衛", 0.8), (3, "F-15", 0.7), (4, "SS", 1.0)], "equipment_id int, keyword string, confidence double")
    got = sorted(map(tuple, linkage.dictionary_match(docs, known, "id", "t", ("SS",)).collect()))
    assert got == [(1, 1, 1.0), (1, 2, 0.9), (2, 3, 0.7)]
    assert (1, 4, 1.0) in set(map(tuple, linkage.dictionary_match(docs, known, "id", "t").collect()))
