"""Cascades, coverage grids, rules and report lines on small frames."""

import datetime

import pytest
from pyspark.sql import functions as F

from tallybrook.functions import rules
from tallybrook.operators import coverage, enrichment, linkage
from tallybrook.sources import reports


def test_requesting_org_cascade(spark):
    contracts = spark.createDataFrame(
        [
            (1, "nda", "x", "x", "v", "20240401", 2024), (2, "atla_riku", "x", "x", "v", "20240401", 2024), (3, "atla", "戦車部品", "戦車部品", "v", "20240401", 2024), (4, "atla", "新型戦車部品一式", "新型戦車部品一式", "v", "20250501", 2025),
            (5, "atla", "艦艇用糧食", "ありふれた", "v", "20240401", 2024), (6, "atla", "共通", "共通品目名", "v", "20240501", 2024), (7, "atla", "共通", "共通品目名", "v", "20240901", 2024), (8, "atla", "z", "zzzz", "ACME corp", None, 2024), (9, "atla", "pump", "pppp", "v", None, 2024), (10, "atla", "none", "nnnn", None, None, 2024),
        ],
        "id long, agency_id string, contract_name string, name_norm string, vendor_name string, contract_date string, fiscal_year int",
    )
    planned = spark.createDataFrame([(1, "GSDF", "戦車部品", 2024, 4), (2, "A", "共通品目名", 2024, 5), (3, "B", "共通品目名", 2024, 6), (4, "B", "共通品目名", 2024, 7)], "id long, org string, name_norm string, fiscal_year int, month int")
    got = {r.id: (r.org, r.source, r.confidence, r.ref) for r in enrichment.requesting_org(contracts, planned, [("nda", "NDA")], [("艦艇", "MSDF")], [("pump", "P")], [("ACME", "V")], "ATLA").collect()}
    assert got == {
        1: ("NDA", "agency", 1.0, None), 2: ("ATLA", "sub_agency", 0.5, None), 3: ("GSDF", "exact", 0.9, 1), 4: ("GSDF", "contained", 0.8, 1), 5: ("MSDF", "override", 0.85, None), 6: ("A", "month", 0.7, 2),
        7: ("B", "majority", 0.5, 3), 8: ("V", "vendor", 0.5, None), 9: ("P", "inferred", 0.5, None), 10: ("ATLA", "fallback", 0.3, None),
    }


def test_requesting_org_by_equipment_and_names(spark):
    rows = [(i, "atla", n, n, v, "20240401", 2024) for i, n, v in [(1, "aaaa", None), (2, "bbbb", "ＡＣＭＥ"), (3, "陸幕 radar", None), (4, "radar", None), (5, "jjjj", None), (6, "kkkk", None), (7, "cccc", None)]]
    rows += [(8, "elsewhere", "陸幕", "x", None, None, 2024), (9, None, "陸幕", "x", None, None, 2024), (10, "atla", "shared", "shared", None, "20240301", 2024)]
    contracts = spark.createDataFrame(rows, "id long, agency_id string, contract_name string, name_norm string, vendor_name string, contract_date string, fiscal_year int")
    planned = spark.createDataFrame([(5, "A", "shared", 2024, 15), (6, "B", "shared", 2024, 15), (7, "B", "shared", 2024, 3)], "id long, org string, name_norm string, fiscal_year int, month int")
    branches = spark.createDataFrame([(1, "MSDF", 2), (1, "GSDF", 1), (1, "MSDF", 3), (7, "ASDF", 9), (7, "GSDF", 8)], "id long, branch string, seq int")
    joint = spark.createDataFrame([(5, "J"), (5, "J"), (6, "J"), (6, "K"), (4, "J")], "id long, org string")
    got = {r.id: (r.org, r.source, r.confidence, r.ref) for r in enrichment.requesting_org(contracts, planned, [("nda", "NDA")], [("zz", "Z")], [("radar", "R")], [("ACME", "V")], "ATLA", [("陸幕", "GSDF")], branches, joint).collect()}
    assert got == {
        1: ("MSDF", "branch", 0.7, None), 2: ("V", "vendor", 0.5, None), 3: ("GSDF", "keyword", 0.75, None), 4: ("R", "inferred", 0.5, None), 5: ("J", "inferred", 0.5, None), 6: ("ATLA", "fallback", 0.3, None),
        7: ("GSDF", "branch", 0.7, None), 8: ("ATLA", "fallback", 0.3, None), 9: ("ATLA", "fallback", 0.3, None), 10: ("B", "majority", 0.5, 6),
    }


def test_category_and_fallbacks(spark):
    df = spark.createDataFrame([(1, "red fuel"), (2, "fuel"), (3, "research of fuel"), (4, "none")], "id int, contract_name string")
    got = enrichment.category(df, [(["red"], "a", 0.9), (["fuel"], "b", 0.6)], [("fuel", "F", 0.6, 0.65), ("research", "R", 0.58, 0.62)])
    rows = {r.id: (r.label, r.confidence) for r in got.collect()}
    assert rows == {1: ("a", 0.9), 2: ("F", 0.6), 3: ("R", 0.58), 4: (None, None)}
    filled = enrichment.org_fallback(got, [(F.col("id") == 4, "x", 0.62), (F.col("id") > 0, "y", 0.6)])
    assert {r.id: r.label for r in filled.collect()}[4] == "x"
    assert tuple(enrichment.agreement(got, filled, "id").first()) == (4, 1.0)


def test_programme_fallback(spark):
    c = spark.createDataFrame([(1, "次期装輪装甲車両の取得"), (2, "哨戒ヘリコプター部品"), (3, "無関係")], "id long, name_norm string")
    p = spark.createDataFrame([("次期装輪装甲車両", "G", ["装輪装甲車両"]), ("哨戒ヘリコプターの取得", "M", ["哨戒ヘリコプター"])], "name_norm string, org string, terms array<string>")
    assert {r.id: (r.org, r.source) for r in enrichment.programme_fallback(c, p).collect()} == {1: ("G", "full_match"), 2: ("M", "kw_match")}


def test_coverage(spark):
    grid = spark.createDataFrame([(1, "http://a/x.pdf", "dash"), (2, "http://b/y.pdf", "dash"), (3, "http://c/z.pdf", "filled"), (4, "http://d/q.pdf", "dash")], "id int, url string, status string")
    loaded = spark.createDataFrame([("http://a/x.pdf",), ("http://other/Y.pdf",)], "source_url string")
    got = {r.id: (r.status, r.strategy) for r in coverage.reconciled(grid, loaded).collect()}
    assert got == {1: ("filled_new", "exact"), 2: ("filled_new", "file"), 3: ("filled", None), 4: ("dash", None)}
    d = datetime.date
    files = spark.createDataFrame([("k456789.pdf", "g", 2024, d(2024, 4, 1), d(2024, 4, 2)), ("k.pdf", "g", 2024, d(2025, 1, 5), d(2025, 3, 9)), ("n.pdf", "g", 2024, d(2024, 4, 1), d(2024, 4, 9))], "file string, agency string, fiscal_year int, first date, last date")
    cells = coverage.rolling_cells(files)
    assert sorted((r.file, r.month) for r in cells.collect()) == [("k.pdf", 1), ("k.pdf", 2), ("k.pdf", 3), *(("k456789.pdf", m) for m in range(4, 10))]
    months = spark.createDataFrame([("g", 2024, 4, "dash", None), ("g", 2024, 5, "filled", "old"), ("g", 2024, 12, "dash", None)], "agency string, fiscal_year int, month int, status string, filename string")
    out = coverage.expanded(months, cells)
    assert {r.month: (r.status, r.filename) for r in out.collect()} == {4: ("filled_new", "k456789.pdf"), 5: ("filled", "old"), 12: ("dash", None)}
    assert tuple(coverage.rates(out, ["agency"]).first()) == ("g", 3, 2, 0.6667)
    assert coverage.facets(out, {"status": ["dash"], "agency": []}).count() == 1
    audit = coverage.header_audit(spark.createDataFrame([("f", "goods", None), ("h", "works", "x")], "filename string, category string, bid_method string"), spark.createDataFrame([("f", "goods", None), ("h", "goods", "x")], "filename string, category string, bid_method string"))
    assert [r.filename for r in audit.collect()] == ["h"]


@pytest.mark.parametrize("url, want", [("http://a/fy2023/x", 2023), ("http://a/2022/x", 2022), ("http://a/r06_k.pdf", 2024), ("http://a/x20240331.pdf", None), ("http://a/r06.03/x.pdf", 2023), ("http://a/x", None)])
def test_year_of_url(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(rules.year_of_url(F.col("u")).alias("r")).first().r == want


def test_rules(spark):
    one = lambda f, v: spark.createDataFrame([(v,)], "v string").select(f(F.col("v")).alias("r")).first().r
    assert one(lambda c: rules.by_keywords(c, [(["kouji"], "works"), (["buppin"], "goods")], "other"), "x/Buppin.html") == "goods"
    prefixes = [("gsdf_", "G"), ("atla", "A")]
    assert [one(lambda c: rules.by_prefix(c, prefixes, "_"), v) for v in ("gsdf_x", "atla", "atlas")] == ["G", "A", None]
    assert one(lambda c: rules.longest_keyword(c, [("局", "a"), ("装備局", "b"), ("課", "c")]), "防衛装備局(某課)") == "c"
    assert [one(rules.month_of_text, v) for v in ("４月", "2024/5", "12", "x")] == [4, 5, 12, None]
    assert one(lambda c: rules.bid_shown(c, {"指名": "指名競争入札"}, ["随意"]), "－") == "不明"
    assert one(lambda c: rules.bid_cleaned(c, [(["総合評価"], "一般競争入札")], ["-"]), "総合 評価") == "一般競争入札"
    assert one(lambda c: rules.terms(c, ["の取得"], ["システム"]), "装輪装甲車 システム") == ["装輪装甲車"]
    assert one(rules.garbled, "\x95\\\x8e\xa6") and not one(rules.garbled, "表示")
    assert one(rules.url_variants, "https://www.a/index.html?q#f")[:3] == ["https://www.a/index.html?q#f", "https://www.a/index.html?q", "http://www.a/index.html?q"]
    assert one(rules.kind_of_file, "zuikei_r6.pdf") == "随契"


def test_report_lines(spark):
    lines = spark.createDataFrame([("f", 1, 1, "1 陸上"), ("f", 1, 2, "・戦車の取得（1両）"), ("f", 2, 1, "・火砲"), ("f", 2, 2, "・123")], "file_id string, page int, line int, text string")
    got = reports.bullets(lines, r"^\d+ (陸上|海上)", "^・(.+)$")
    assert sorted((r.section, r.name) for r in got.collect()) == [("陸上", "戦車の取得"), ("陸上", "火砲")]
    pages = spark.createDataFrame([("f", 1, "A")], "file_id string, page int, category string")
    plan = spark.createDataFrame([("f", 1, 1, "○装備品1,200億円 ○整備（30億円）")], "file_id string, page int, line int, text string")
    assert sorted((r.name, r.oku) for r in reports.category_lines(plan, pages).collect()) == [("整備", 30.0), ("装備品", 1200.0)]
    files = spark.createDataFrame([("k20240401.pdf", ["1", "12,000円", "甲社"]), ("x.pdf", ["甲", "9"])], "file string, cells array<string>")
    r = reports.dated_results(files).collect()
    assert [(x.contract_date, x.fiscal_year, x.contract_amount, x.vendor_name) for x in r] == [("20240401", 2024, 12000, "甲社")]
    items = reports.planned_items(spark.createDataFrame([("f", 1, ["01", "戦車(改)", "2", "1月"]), ("f", 2, ["99", "x", "1", "4月"])], "file_id string, row int, cells array<string>"), {"01": "陸自"})
    assert [(x.org, x.item_name_norm, x.contract_month) for x in items.collect()] == [("陸自", "戦車改", 13)]
    portal = spark.createDataFrame([("f", 1, True, "令和5年度 事前の評価"), ("f", 2, False, "甲")], "file_id string, line int, is_heading boolean, text string")
    assert [(x.fiscal_year, x.kind, x.text) for x in reports.portal_rows(portal).collect()] == [(2023, "事前", "甲")]
    assert reports.without_placeholders(spark.createDataFrame([("0一式", "x", 1), ("1", None, None), (None, None, 5)], "quantity string, contract_date string, contract_amount int")).count() == 1
    assert reports.with_neighbour(lines, "戦車").first().after is None


def test_programmes_meet_each_name_once(spark, monkeypatch):
    made, either = [], linkage.either_contains
    monkeypatch.setattr(linkage, "either_contains", lambda *a, **k: made.append(either(*a, **k)) or made[-1])
    contracts = spark.range(300).selectExpr("id", "if(id % 3 = 0, 'large ring set', if(id % 3 = 1, 'blue bolt set', null)) as name_norm")
    programmes = spark.range(200).selectExpr("'large ring' as name_norm", "'army' as org", "array('ring') as terms")
    programmes = programmes.unionAll(spark.sql("select 'blue gear', 'navy', array('blue') union all select 'old bolts', 'army', array('set', 'bolt')"))
    got = {r.id: (r.org, r.source) for r in enrichment.programme_fallback(contracts, programmes).collect()}
    assert got == {i: ("army", ("full_match", "kw_match")[i % 3]) for i in range(300) if i % 3 < 2}
    assert made[0].count() == 1


def test_an_id_of_several_names_has_all_their_words(spark):
    contracts = spark.createDataFrame([(1, "red ring"), (1, "red bolt"), (2, "red ring"), (2, "red ring"), (3, "xx")], "id int, name_norm string")
    programmes = spark.createDataFrame([("aaaaaa", "army", ["ring", "bolt"]), ("bbbbbb", "navy", ["red"]), ("red ring", None, None)], "name_norm string, org string, terms array<string>")
    got = {r.id: r.org for r in enrichment.programme_fallback(contracts, programmes).collect()}
    assert got == {}
    more = programmes.unionAll(spark.sql("select 'cccccc', 'navy', array('rin')"))
    assert {r.id: r.org for r in enrichment.programme_fallback(contracts, more).collect()} == {1: "navy", 2: "navy"}
