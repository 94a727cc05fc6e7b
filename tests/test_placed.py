"""Pages read one at a time: odd words, and plans that lay a table out once."""

import numpy as np
import pyarrow as pa
import pytest

from tallybrook.plans import registry
from tallybrook.sources import grids, layouts, pages, placed

RULES = [("件名", "contract_name"), ("契約金額", "contract_amount"), ("方式", "bid_method")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["page_records", "text_grids", "tiered_contracts"])
def test_words_are_laid_out_once(spark, sf, name):
    text = plan(registry.QUERIES[name](spark, sf))
    ruled = 2 if name == "tiered_contracts" else 0  # head and rows of ruled tables
    assert text.count("Scan parquet") == 1 + ruled and text.count("MapInArrow") == 1
    assert ruled or text.count("Exchange hashpartitioning") == 1  # words of a page stay where its items are


def test_words_without_places_and_texts():
    words = [(None, 0.0, 1.0, "a"), (0.0, None, 1.0, "b"), (0.0, 0.0, 1.0, None), (5.0, 6.0, 9.0, "c"), (5.0, 6.5, 9.0, "d")]
    assert placed.lines_of(words, 6.0) == [[words[0], words[2], words[3]], [words[4]], []]
    assert placed.lines_of([], 6.0) == []
    assert placed.islands([(5.0, 6.0), (None, 1.0), (2.0, None), (5.5, 9.0)], 0.0) == [[None, 1.0], [2.0, None], [5.0, 9.0]]
    assert placed.grid([], 3.0) is None and placed.grid([(None, None, None, None, "x")] * 3, 3.0) is None


def test_rows_under_a_header():
    tables = [[None, ["件名", "契約\n金額", "方式"], ["a", "1円", "x"], ["b", "-", "〃"], ["c", "2", "〃"], None, ["d", "3"]], [["件名", "契約金額"]], []]
    got = list(placed.paid_rows(tables, RULES, "契約金額", "件名", 6, ["〃"], ["contract_amount", "contract_name", "bid_method"]))
    assert got == [(0, 2, "1円", "a", "x", "1円"), (0, 4, "2", "c", "x", "2"), (0, 6, "3", "d", None, "3")]


def test_numbers_beyond_all_others(spark):
    nan = float("nan")
    rows = [("f", 1, t, x, x + 10, y) for t, x, y in [("件名", 0.0, 0.0), ("契約金額", 50.0, 0.0), ("a", 0.0, 20.0), ("12", 50.0, 20.0), ("b", nan, 20.0), ("34", 50.0, nan), ("56", 50.0, 40.0)]]
    df = spark.createDataFrame(rows, "file_id string, page int, text string, x0 double, x1 double, top double")
    assert sorted((r.contract_name or "", r.contract_amount) for r in pages.word_records(df, RULES, []).collect()) == [("a", 12), ("a", 56)]
    assert layouts.tiered(df.limit(0)).count() == 0


def test_tags_of_other_names_are_passed_over():
    whole = "<table><tr><td> <b>1</b> (PDF:1KB)</td><td>契約金額</td></tr></table>"
    assert grids.page_tables(whole) == [[["1", "契約金額"]]]
    assert set(m[3] for m in grids._tags(frozenset(["td", "tr"])).finditer(whole)) == {"td", "tr"}
    for odd in ('<i title="<td>x</td>">', "<!-- <td>x</td> -->", "<SCRIPT><td>x</td></SCRIPT>"):
        assert grids.TANGLED.search(odd) and grids.elements(odd, frozenset(["td"])) == [e for e in grids.elements(odd) if e[0] == "td"]


def test_lists_are_read_once(spark, sf):
    whole = registry.QUERIES["planned_lists"](spark, sf)
    assert "Scan parquet" not in plan(whole)  # lines were read and written once; they are numbered from there
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # borders pass from batch to batch
    try:
        assert sorted(map(str, registry.QUERIES["planned_lists"](spark, sf).collect())) == sorted(map(str, whole.collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_main_items_are_laid_out_once(spark, sf):
    text = plan(registry.QUERIES["main_item_lists"](spark, sf))
    assert text.count("Scan parquet") == 2 and text.count("MapInArrow") == 2  # even and odd pages
    assert text.count("Exchange hashpartitioning") == 2 and "Window" not in text
    nan = float("nan")
    rows = [("f", 1, t, x, y) for t, x, y in [("空幕", 20.0, 10.0), ("機体", 100.0, 30.0), ("1,0", 400.0, 31.0), ("x", nan, 30.0), ("y", None, 30.0), ("z", 420.0, None), ("戦車\u2028", 100.0, 45.0), ("12\u2028", 100.0, 45.0), ("9", 420.0, nan)]]
    df = spark.createDataFrame(rows, "file_id string, page int, text string, x0 double, top double")
    got = layouts.main_items(df, (60, 330), (330, 390), 395, 80, "幕", "品目", False).select("line", "org", "item_name", "amount", "vendor_name").collect()
    assert sorted(map(tuple, got)) == [(1, "空幕", "機体", 10.0, None), (2, "空幕", "戦車\u2028", None, None)]


def test_grids_of_many_pages_are_read_at_once(monkeypatch):
    nan, kind = float("nan"), pa.list_(pa.struct([(c, pa.float64()) for c in ("top", "x0", "x1", "bottom")] + [("text", pa.string())]))
    title, low = [(0.0, 0.0, 200.0, 8.0, "over all")], [(20.0, 5.0, 15.0, 28.0, "a"), (20.0, 60.0, 70.0, 28.0, "b")]
    good = [*title, *low, (40.0, 0.0, 1.0, 48.0, "l"), (40.0, 6.0, 9.0, 48.0, "c"), (41.0, 12.0, 15.0, 49.0, "c2"), (41.0, 61.0, 65.0, 48.0, "d")]
    joined = [*low, (40.0, 5.0, 62.0, 48.0, "wide"), (40.0, 90.0, 95.0, 48.0, "e"), (50.0, 5.0, 20.0, 58.0, "f"), (50.0, 60.0, 65.0, 58.0, "g")]
    odd = [[(None, None, 1.0, None, "n"), *low, *good[3:]], [*good, (nan, 5.0, 6.0, nan, "x")], [(0.0, 9.0, 2.0, -1.0, "y"), *good[1:]]]
    told = [good, [], title, low, joined, *odd, good[1:]]
    want = [(p, i, cells) for p, ws in enumerate(placed.lists(pa.array(told, kind))) for i, cells in enumerate(placed.grid(ws, 3.0) or [])]
    seen, one = [], placed.grid
    monkeypatch.setattr(placed, "grid", lambda ws, gap: seen.append(ws) or one(ws, gap))
    page, row, cells = placed.grids(pa.array(told, kind), np.ones(len(told), bool), 3.0)
    assert list(zip(page, row, cells.to_pylist())) == want and len(seen) == len(odd) and len(want) > 15
    page, _, _ = placed.grids(pa.array([None, *told], kind).slice(1), np.arange(len(told)) > 0, 3.0)
    assert set(page) == {p for p, _, _ in want} - {0}


def test_tables_are_rows_at_once(spark, sf):
    text = plan(registry.QUERIES["text_grids"](spark, sf))
    assert text.count("Generate") == 1 and text.count("collect_list(w") == 2  # words alone are laid out and gathered, in two steps
    rows = [("f", 1, "a", 0.0, 5.0, 0.0), ("f", 1, "b", 50.0, 55.0, 0.0), ("f", 1, "c", 0.0, 5.0, 20.0), ("f", 1, "d", 50.0, 55.0, 20.0), ("g", 1, "e", 0.0, 5.0, 0.0)]
    words = spark.createDataFrame(rows, "file_id string, page int, text string, x0 double, x1 double, top double")
    ruled = spark.createDataFrame([("h", 1, 7, 4, ["z", None]), ("h", 1, None, 2, ["y"]), ("h", 1, 7, 9, None)], "file_id string, page int, table int, row int, cells array<string>")
    got = sorted(map(tuple, layouts.table_rows(words, ruled).collect()), key=lambda r: r[:5])
    assert got == [("f", 1, "text", 0, 0, ["a", "b"]), ("f", 1, "text", 0, 1, ["c", "d"]), ("h", 1, "ruled", 0, 0, ["y"]), ("h", 1, "ruled", 1, 0, ["z", None]), ("h", 1, "ruled", 1, 1, None)]
