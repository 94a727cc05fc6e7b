"""Merges, votes, linkage, grids, streams and reconciliation on small frames."""

import gzip

import pytest
from pyspark.sql import functions as F

from tallybrook.operators import fuzzy, linkage, merge, verify, votes, windows
from tallybrook.plans import registry
from tallybrook.sources import exports, grids
from tallybrook.streaming import incremental


def test_insert_if_absent(spark):
    old = spark.createDataFrame([("a", 1, 0)], "k string, n int, seq int")
    new = spark.createDataFrame([("a", 1, 1), ("b", 1, 3), ("b", 1, 2), (None, 1, 4), (None, 1, 5)], old.schema)
    got = sorted((r.k or "", r.seq) for r in merge.insert_if_absent(old, new, ["k", "n"], "seq").collect())
    assert got == [("", 4), ("", 5), ("b", 2)]
    same = merge.insert_if_absent(old, new, ["k", "n"], "seq", "same").collect()
    assert sorted(r.seq for r in same) == [2, 4]
    assert tuple(merge.insert_counts(old, new, ["k", "n"], "seq").first()) == (3, 2)


def test_upsert_patch_clone(spark, tmp_path):
    t = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    new = spark.createDataFrame([(2, "z", 1), (2, "w", 2), (3, "n", 1)], "id int, v string, seq int")
    assert sorted(map(tuple, merge.upsert(t, new, ["id"], "seq").collect())) == [(1, "x"), (2, "w"), (3, "n")]
    patched = merge.patch(t, spark.createDataFrame([(1, "p"), (2, "p")], t.schema), "id", ["v"], F.col("v") == "x")
    assert sorted(map(tuple, patched.collect())) == [(1, "p"), (2, "y")]
    grid = spark.createDataFrame([(1, 2023, "filled"), (2, 2022, "dash")], "id int, fy int, s string")
    assert merge.cloned_grid(grid, "fy", 2023, [2024, 2025], {"s": "dash"}).where("s = 'dash'").count() == 3
    assert merge.gap_fill(t, new.select("id", "v"), ["id"]).count() == 3
    assert merge.with_missing(t, {"w": "int"}).columns == ["id", "v", "w"]
    assert merge.replace_unprotected(t, new.select("id", "v", "seq").drop("seq").withColumn("seq", F.lit(1)).select("id", "v", "seq"), ["id"], F.col("v") == "x", "seq").count() == 3


def test_votes(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3), ("b", "x", 4), ("c", None, 5)], "k string, v string, s int")
    assert {r.k: r.v for r in votes.majority(df, "k", "v", "s").collect()} == {"a": "x", "b": "x"}
    assert {r.k for r in votes.unanimous(df, "k", "v").collect()} == {"b"}
    assert {r.k for r in votes.plurality(df, "k", "v").collect()} == {"b"}


def test_substring_join_loses_nothing(spark):
    left = spark.createDataFrame([(i, s) for i, s in enumerate(["abcdefgh", "cdef", "zz", "xxcdefyy", ""])], "id int, a string")
    right = spark.createDataFrame([("cdef", 1), ("abcd", 2), ("abcdefghij", 3), ("zz", 4)], "b string, seq int")
    got = {(r.id, r.b) for r in linkage.either_contains(left, right, "a", "b").collect()}
    want = {(i, b) for i, a in left.collect() for b, _ in right.collect() if min(len(a), len(b)) >= 4 and (b in a or a in b)}
    assert got == want
    short = {(r.id, r.b) for r in linkage.contains_join(left, right, "a", "b").collect()}
    assert short == {(i, b) for i, a in left.collect() for b, _ in right.collect() if b in a}  # of any length
    best = {r.id: r.b for r in linkage.longest_contained(left, right, "id", "a", "b", "seq").collect()}
    assert best == {0: "abcdefghij", 1: "abcdefghij", 3: "cdef"}


def test_years(spark):
    df = spark.createDataFrame([(2020, [2019, 2021]), (2020, [2020]), (2020, [2010])], "y int, ys array<int>")
    got = df.select(linkage.year_confidence(F.col("y"), F.col("ys")), linkage.nearest_year(F.col("y"), F.col("ys"))).collect()
    assert [tuple(map(float, r)) for r in got] == [(0.8, 2019), (0.9, 2020), (0.65, 2010)]


@pytest.mark.parametrize("a, b, want", [("abc", "abc", 100), ("", "a", 0), ("a b", "b a c", 100), ("abcd", "abxd", 75)])
def test_token_set_ratio(a, b, want):
    assert fuzzy.token_set_ratio(a, b) == pytest.approx(want)


def test_relinked(spark):
    ids = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None)], "id long, k string")
    e = spark.createDataFrame([("a", "p", 1), ("a", "q", 2), ("b", "p", 1), ("b", "p", 2), (None, "p", 1), ("z", "p", 1)], "k string, v string, dup_ordinal int")
    got = {(r.k, r.v, r.dup_ordinal, r.status, r.id) for r in linkage.relinked(e, ids, ["k"], "v").collect()}
    assert ("z", "p", 1, "unmatched", None) in got and (None, "p", 1, "matched", 4) in got and ("a", "p", 1, "matched", 1) in got and ("b", "p", 1, "matched", 3) in got
    strict = {(r.k, r.v, r.id) for r in linkage.relinked(e, ids, ["k"], "v", "reference").collect() if r.id}
    assert ("a", "p", 1) not in strict and ("a", "q", 1) in strict


def test_grid_records(spark):
    cells = [["表題"], ["番号", "件名", "契約相手方", "契約金額", "契約日", "契約方式"], ["1", "甲", "A社\n東京", "1,000円", "R6.4.1", "一般競争"], ["2", "乙", "B社", "2,000", "2024/5/1", "〃"], ["3", "丙", "", "", "", ""], ["4", "", "C社", "予定調達総額 1,234円", "", "随意契約"]]
    grid = spark.createDataFrame([("f", i, c) for i, c in enumerate(cells)], "file_id string, row int, cells array<string>")
    headers = grids.header_rows(grid, ["件名", "契約金額", "契約相手方"])
    rules = [("件名", "contract_name"), ("契約相手方", "vendor_name"), ("契約金額", "contract_amount"), ("契約日", "contract_date"), ("契約方式", "bid_method")]
    columns = grids.column_map(grid, headers, rules)
    got = {r.row: r for r in grids.records(grid, headers, columns, [("一般競争", "一般競争入札"), ("随意", "随意契約")]).collect()}
    assert set(got) == {2, 3, 5}
    assert (got[2].vendor_name, got[2].vendor_address, got[2].contract_amount, got[2].contract_date, got[2].fiscal_year) == ("A社", "東京", 1000, "20240401", 2024)
    assert got[3].bid_method == "一般競争入札" and got[5].contract_amount == 1234


def test_sheet_records_gather_a_sheet_once(spark, sf):
    cells = [["表題"], ["番号", "件 名", "契約相手方", "契約金額", "契約日", "契約方式"], ["1", "甲", "A社\n東京", "1,000円", "R6.4.1", "一般競争"], ["2", "乙", "B社", "2,000", "2024/5/1", "〃"], ["3", "丙", "", "", "", ""], None, ["4", "", "C社", "予定調達総額 1,234円", "", "随意契約"]]
    other = [("g", 0, ["件名", "契約金額"]), ("g", 20, ["a", "5"]), ("h", 0, ["x"]), ("h", 1, ["y"]), (None, 0, ["件名", "契約金額"]), (None, 1, ["a", "5"]), ("i", -1, ["b", "契約金額", None]), ("i", 16, ["件名", "契約金額"]), ("i", None, ["c", "7"])]
    grid = spark.createDataFrame([*(("f", i, c) for i, c in enumerate(cells)), *other], "file_id string, row int, cells array<string>")
    words, bids = ["件名", "契約金額", "契約相手方"], [("一般競争", "一般競争入札"), ("随意", "随意契約")]
    rules = [("件名", "contract_name"), ("番号", "contract_name"), ("契約相手方", "vendor_name"), ("契約金額", "contract_amount"), ("契約日", "contract_date"), ("契約方式", "bid_method")]
    for least, default in ((2, None), (2, 0), (1, None), (3, 16)):
        heads = grids.header_rows(grid, words, least, default)
        joined = grids.records(grid, heads, grids.column_map(grid, heads, rules), bids)
        got = grids.sheet_records(grid, words, rules, bids, least, default)
        assert sorted(map(str, got.collect())) == sorted(map(str, joined.collect()))
    text = registry.QUERIES["grid_records"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan parquet") == 1 and text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_lines_bands_html(spark):
    words = spark.createDataFrame([("f", 1, "b", 20.0, 3.0, 0.9), ("f", 1, "a", 1.0, 0.0, 0.9), ("f", 1, "c", 1.0, 12.0, 0.9), ("f", 1, "no", 1.0, 12.0, 0.1)], "file_id string, page int, text string, x0 double, top double, conf double")
    assert sorted((r.line, r.text) for r in grids.lines_of_words(words).collect()) == [(0, "a b"), (1, "c")]
    anchors = windows.midpoint_bands(spark.createDataFrame([("f", 1, 1, 0.0), ("f", 1, 2, 10.0)], "file_id string, page int, anchor int, at double"), ["file_id", "page"], "at")
    assert {(r.text, r.anchor) for r in grids.banded(words, anchors).collect()} == {("a", 1), ("b", 1), ("c", 2), ("no", 2)}
    pages = spark.createDataFrame([(1, "http://h/a/b.html", '<table><tr><th>x</th><td> y <b>z</b></td></tr></table><a href="c.pdf">.</a><a href="/d.pdf">.</a>')], "page_id int, url string, html string")
    assert [r.cells for r in grids.html_rows(pages).collect()] == [["x", "y z"]]
    assert {r.link for r in grids.html_links(pages, [".pdf"]).collect()} == {"http://h/a/c.pdf", "http://h/d.pdf"}
    assert {r.link for r in grids.html_links(pages, [".pdf"], "^c").collect()} == {"http://h/a/c.pdf"}
    sheets = [("http://h/x/i.html", '<!-- Excel Workbook Frameset --><link href="i.files/sheet001.html">'), ("http://h/x/i.files/sheet001.html", '<a href="../e.pdf">.</a>')]
    sites = spark.createDataFrame([(i, *s) for i, s in enumerate(sheets)], pages.schema)
    assert [(r.page_id, r.link) for r in grids.html_links(grids.framed(sites), [".pdf"]).collect()] == [(0, "http://h/x/e.pdf")]
    tables = ["<table><tr><td>契約金額</td></tr><tr><td> </td></tr></table><table><tr><td>1 (PDF:2KB)</td></tr></table>", "<table><tr><td>a</td></tr></table><table><tr><td>a</td></tr><tr><td>b</td></tr></table>", None]
    got = grids.html_tables(spark.createDataFrame([(i, "", t) for i, t in enumerate(tables)], pages.schema)).collect()
    assert sorted((r.page_id, r.table, r.row, r.cells) for r in got) == [(0, 0, 0, ["契約金額"]), (0, 1, 0, ["1"]), (1, 0, 0, ["a"]), (1, 0, 1, ["b"])]
    links = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c"), ("c", "d")], "src string, dst string")
    assert {(r.url, r.depth) for r in grids.crawl(links, spark.createDataFrame([("a",)], "url string"), 2).collect()} == {("a", 0), ("b", 1), ("c", 2)}
    grid = grids.url_grid(spark, "http://%s/%d", host=["a", "b"], year=[1, 2])
    assert {r.url for r in grid.collect()} == {"http://a/1", "http://a/2", "http://b/1", "http://b/2"}


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "甲", "x"), (2, "乙", "y")], "id long, name string, category string")
    exports.csv_by_category(df, str(tmp_path / "csv"), "category")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    exports.jsonl(df, str(tmp_path / "j"), "v1")
    assert grids.jsonl(spark, str(tmp_path / "j"), "id long, name string, category string").count() == 2
    assert gzip.open(sorted((tmp_path / "j").glob("part-*"))[0], "rt").read() == '{"_meta":"v1"}\n'
    exports.csv_download(df, str(tmp_path / "d"), ["id"], 1)
    assert next((tmp_path / "d").glob("part-*")).read_text() == "\ufeffid,name,category\n1,甲,x\n"
    assert grids.csv(spark, str(tmp_path / "d")).columns == ["id", "name", "category"]
    book = exports.sheets(df, {"by category": ["category"], "all": []}, "id", ["id"])
    assert [tuple(r) for r in book["by category"].collect()] == [("y", 1, 2, 2.0), ("x", 1, 1, 1.0)] and book["all"].first().rows == 2 and book["detail"].count() == 2
    assert exports.schemas({"b": df, "a": df.select("id")}, {"i": ("b", ["id"])}) == ["CREATE TABLE a (id BIGINT)", "CREATE TABLE b (id BIGINT, name STRING, category STRING)", "CREATE INDEX i ON b (id)"]
    (tmp_path / "s.html").write_bytes("表".encode("cp932"))
    files = spark.read.format("binaryFile").load(str(tmp_path / "s.html"))
    assert grids.decoded(files).first().text == "表"
    rows = grids.payments(spark.createDataFrame([(1, '[{"name":"a","amount":5},{"name":"b"}]')], "id int, p string"), "p", ["id"])
    assert [(r["rank"], r.name, r.amount) for r in rows.orderBy("rank").collect()] == [(1, "a", 5), (2, "b", None)]
    top, notice = exports.capped(df, ["id"], 1)
    assert top.count() == 1 and notice.first().cut


def test_verify(spark):
    e = spark.createDataFrame([("a", 100), ("b", 100), ("c", 100)], "k string, n long")
    a = spark.createDataFrame([("a", 99), ("b", 98)], e.schema)
    cells = verify.reconcile(e, a, ["k"], "n", 0.01)
    assert {r.k: r.ok for r in cells.collect()} == {"a": True, "b": False, "c": False}
    assert [r.k for r in verify.largest_gaps(cells, ["k"]).collect()] == ["c", "b", "a"]
    assert verify.missing(e, a, ["k"], "n").count() == 3
    assert verify.verdict([("x", False, "warn")]) == "WARN" and verify.verdict([("x", False, "fail")]) == "FAIL" and verify.verdict([]) == "PASS"


def test_streams(spark, sf, tmp_path):
    schema = "k string, seq int"
    for i, rows in enumerate([[("a", 1), ("b", 2)], [("a", 3), ("c", 4)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        incremental.append_new(spark.readStream.schema(schema).json(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"), ["k"], "seq").awaitTermination()
    assert sorted((r.k, r.seq) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a", 1), ("b", 2), ("c", 4)]
    q = incremental.windowed(incremental.events(spark, f"{sf}/events.parquet*")).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select sum(n) s from w").first().s == spark.read.parquet(f"{sf}/events.parquet").count()


def test_bigram_jaccard_compares_equal_texts_once(spark, monkeypatch):
    left = spark.range(400).selectExpr("id", "if(id % 2 = 0, 'small ring', 'xyz') as t")
    right = spark.createDataFrame([("small rings",), ("small rings",), ("",)], "n string")
    got = linkage.bigram_jaccard_join(left, right, "id", "t", "n")
    assert {(r.id, r.n, round(r.jaccard, 6)) for r in got.collect()} == {(i, "small rings", 0.9) for i in range(0, 400, 2)} and got.count() == 200
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 3 and plan.count("Join") == 2  # both sides are made distinct before they are cut
