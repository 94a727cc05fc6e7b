"""Scalar functions against values worked out by hand."""

import itertools

import pytest
from pyspark.sql import functions as F

from tallybrook.functions import amounts, dates, rules, text


def of(spark, f, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("value, want", [("R6.4.1", "20240401"), ("6.4.1", "20240401"), ("令和6年4月1日", "20240401"), ("2024/4/1", "20240401"), ("2024年12月31日", "20241231"), ("20240401", "20240401"), ("45383", "20240401"), ("x", None), (None, None), ("2024/13/40", "20241340"), ("12-05-2024", None), ("6-4-1", None), ("2024.4.1", None), ("契約 2024/4/1", None), ("r6.4.1", "20240401"), ("R21.4.1", None)])
def test_date_text(spark, value, want):
    assert of(spark, dates.date_text, value) == want


@pytest.mark.parametrize("value, want", [("20240331", 2023), ("20240401", 2024), ("2024041", None), (None, None), ("abcdefgh", None)])
def test_fiscal_year_of_text(spark, value, want):
    assert of(spark, dates.fiscal_year_of_text, value) == want


@pytest.mark.parametrize("value, want", [("令和元年度", 2019), ("平成30年", 2018), ("x", None)])
def test_era_year(spark, value, want):
    assert of(spark, dates.era_year, value) == want


def test_spaced_era_date(spark):
    assert of(spark, dates.spaced_era_date, "契約 令和 6 . 4 . 1") == "20240401"


def test_months_covered(spark):
    df = spark.sql("select date'2024-02-10' a, date'2024-06-01' b")
    assert df.select(dates.months_covered(F.col("a"), F.col("b"), F.lit(2024)).alias("m")).first().m == [4, 5, 6]
    assert df.select(dates.months_covered(F.col("a"), F.col("b"), F.lit(2030)).alias("m")).first().m is None


@pytest.mark.parametrize("value, want", [("1,234円", 1234), ("￥ 5", 5), ("2.5", 2), ("3.5", 4), ("-13", -13), ("-", None), (None, None)])
def test_amount(spark, value, want):
    assert of(spark, amounts.amount, value) == want


@pytest.mark.parametrize("value, want", [("100 2,000円", 2000), ("x 7 y", 7), ("x", None)])
def test_last_amount(spark, value, want):
    assert of(spark, amounts.last_amount, value) == want


def test_unit_price_and_zero(spark):
    df = spark.createDataFrame([(["a", "予定調達総額 1,234円"], 0)], "c array<string>, z int")
    r = df.select(amounts.unit_price_total(F.col("c")).alias("u"), amounts.first_nonzero(F.col("z"), F.lit(7)).alias("z")).first()
    assert (r.u, r.z) == (1234, 7)


@pytest.mark.parametrize("value, want", [("95.2%", 95.2), ("0.952", 95.2), ("x", None)])
def test_rate(spark, value, want):
    assert of(spark, amounts.rate, value) == want


def test_oku_and_scale(spark):
    assert of(spark, amounts.oku, "約1兆2,000億円と30億") == 12030
    assert of(spark, lambda c: amounts.scaled(c, 1, 100), 5000.0, "double") == 50


@pytest.mark.parametrize("value, want", [("㈱A", "A株式会社"), ("（株）A", "A株式会社"), ("株式会社A", "A株式会社"), ("A株式会社", "A株式会社"), ("A  有限会社", "A 有限会社"), ("", None), (None, None)])
def test_vendor(spark, value, want):
    assert of(spark, text.vendor, value) == want


def test_names(spark):
    assert of(spark, text.item_name, "Ｆ－３５Ａ（改）") == "f35a改"
    assert of(spark, text.nfkc, "ＡＢＣ") == "ABC"
    assert of(spark, text.without_parentheses, "甲(乙)（丙）") == "甲"
    assert of(spark, text.model_names, "F-35A") == ["F-35", "F-35A", "F35", "F35A"]
    assert of(spark, text.model_names, "CH-47J/JA") == ["CH-47", "CH-47J", "CH-47J/JA", "CH-47JA", "CH47", "CH47J", "CH47J/JA", "CH47JA"]
    assert of(spark, text.corporate_number, "1234-5678-90123") == "1234567890123"
    assert of(spark, text.corporate_number, "123") is None
    assert of(spark, text.cp932_repaired, "表示".encode("cp932").decode("latin-1")) == "表示"


@pytest.mark.parametrize("value, want", [("456789101112123", [4, 5, 6, 7, 8, 9, 10, 11, 12, 1, 2, 3]), ("44", []), ("12", [12]), ("", [])])
def test_rolling_months(spark, value, want):
    assert of(spark, text.rolling_months, value) == want


def test_bids_and_urls(spark):
    assert of(spark, lambda c: text.bid_method(c, [("随意", "随意契約")]), "公募型随意契約") == "随意契約"
    assert of(spark, text.bid_class, "随意") == "随契"
    assert of(spark, text.file_type, "http://a.jp/x/B.XLSX?y") == "excel"
    assert of(spark, text.basename, "http://a.jp/x/b.pdf") == "b.pdf"
    assert of(spark, text.trailing_digits, "kekka0407.pdf") == "0407"
    assert of(spark, lambda c: text.vendor_and_address(c)[1], "A\n東京\n1-2") == "東京 / 1-2"
    assert of(spark, lambda c: text.listed(F.split(c, ""), 2), "abc") == "a, b 他1件"


@pytest.mark.parametrize("function, value, want", [
    (text.item_name, "『ミサイルー』 ‐改_Ａ", "ミサイル改a"), (text.item_name, None, ""), (text.item_name, "a.b", "a.b"), (text.programme_name, "F-35A：“ABC”〜", "f35a“abc”"), (text.programme_name, "Ｆ－35A 'ABC'", "f35aabc"),
    (text.equipment_name, "ミサイルー", "ミサイルー"), (text.equipment_name, "F―35–A", "F-35-A"), (text.vendor, "合名会社山田", "山田合名会社"), (text.vendor, "株式会社A有限会社", "株式会社A有限会社"), (text.vendor, " ", None),
    (text.vendor_plain, "(合)山田", "(合)山田"), (text.vendor_plain, "", ""), (text.vendor_plain, None, None), (amounts.last_amount, "1,234円 5.5", 6), (amounts.last_amount, "1000.5", 1000), (amounts.last_amount, "abc 12円也", 12),
    (amounts.last_amount, "▲100", 100), (amounts.last_amount, "1-2 -", None), (rules.year_of_url, "https://x/r6.3/a.pdf", 2023), (rules.year_of_url, "https://x/R6_4", 2024), (rules.year_of_url, "https://x/r06/2025/", 2024), (rules.year_of_url, "https://x/FY2023/r06/", 2023),
])
def test_goldens_of_the_source_rules(spark, function, value, want):
    assert of(spark, function, value) == want


def test_rolling_months_cut_by_a_pattern_are_those_walked(spark):
    def walked(digits):
        out, at = [], 0
        while at < len(digits):
            two = digits[at : at + 2]
            take = two in ("10", "11", "12") and int(two) not in out
            month = int(two) if take else int(digits[at])
            if month in out or month == 0:
                return []
            out.append(month)
            at += 2 if take else 1
        return out

    texts = ["".join(t) for n in range(6) for t in itertools.product("0124", repeat=n)] + ["456789101112123", "1211101", "4564"]
    df = spark.createDataFrame(list(enumerate([*texts, None, "4x", "４", "4\n"])), "i int, t string")
    got = {r.i: r.m for r in df.select("i", text.rolling_months(df.t).alias("m")).collect()}
    assert got == {i: walked(t) for i, t in enumerate(texts)} | {len(texts) + i: [] for i in range(4)}


def test_months_of_a_constant_are_not_walked_in_each_row(spark):
    df = spark.range(3).select(text.rolling_months(F.lit("4564")).alias("again"), text.rolling_months(F.lit("45610")).alias("m"))
    assert [(r.again, r.m) for r in df.collect()] == [([], [4, 5, 6, 10])] * 3
    assert "aggregate(" not in df._jdf.queryExecution().optimizedPlan().toString()
