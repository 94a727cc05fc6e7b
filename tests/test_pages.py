"""Records of unruled pages, scans and lists, each on a hand-made page."""

from pyspark.sql import functions as F

from tallybrook.functions import dates
from tallybrook.sources import pages

WORDS = "file_id string, page int, text string, x0 double, x1 double, top double"
RULES = [("件名", "contract_name"), ("契約日", "contract_date"), ("相手方", "vendor_name"), ("契約金額", "contract_amount"), ("方式", "bid_method")]


def word(text, x, top, page=1):
    return ("f", page, text, float(x - 5), float(x + 5), float(top))


def test_word_records(spark):
    head = [word("件名", 100, 10), word("契約日", 200, 10), word("相手方", 300, 14), word("契約金額", 400, 10), word("方式", 500, 10)]
    one = [word("船体", 100, 30), word("R6.4.1", 205, 40), word("甲社", 300, 40), word("1,000円", 390, 40), word("一般競争", 500, 40), word("修理", 100, 38)]
    two = [word("役務", 100, 200), word("2019/5/1", 200, 200), word("乙社", 300, 200), word("2,000", 400, 200)]
    lost = [word("丙社", 340, 400), word("3,000", 400, 400)]  # its vendor stands between the columns
    df = spark.createDataFrame(head + one + two + lost, WORDS)
    got = {r.contract_amount: r for r in pages.word_records(df, RULES, [("一般競争", "一般競争入札")]).collect()}
    assert set(got) == {1000, 2000}
    assert (got[1000].contract_name, got[1000].vendor_name, got[1000].contract_date, got[1000].bid_method, got[1000].fiscal_year) == ("船体 修理", "甲社", "20240401", "一般競争入札", 2024)
    assert [r.contract_amount for r in pages.word_records(df, RULES, [], [2019]).collect()] == [2000]
    assert pages.word_records(df.where("top > 20"), RULES, []).count() == 0  # no header
    assert pages.word_records(df.limit(0), RULES, []).count() == 0


def test_word_records_name_left_of_columns(spark):
    head = [word("名称", 300, 10), word("契約金額", 400, 10)]
    df = spark.createDataFrame([*head, word("甲", 100, 30), word("甲", 120, 30), word("乙", 140, 30), word("500", 400, 30), word("x", 600, 60)], WORDS)
    assert [(r.contract_name, r.contract_amount) for r in pages.word_records(df, [("契約金額", "contract_amount"), ("名称", "vendor_name")], []).collect()] == [("甲 乙", 500)]


def test_line_records(spark):
    texts = ["公共調達の適正化について", "航空機用部品の製造請負", "株式会社甲乙", "1234567890123", "令和6年5月7日 1,234,000 99,999", "東京都港区", "小計 9,000,000", None]
    df = spark.createDataFrame([("f", 1, i, t) for i, t in enumerate(texts)], "file_id string, page int, line int, text string")
    (r,) = pages.line_records(df).collect()
    assert (r.contract_name, r.vendor_name, r.vendor_address, r.corporate_number, r.contract_date, r.fiscal_year, r.contract_amount) == ("航空機用部品の製造請負", "株式会社甲乙", "東京都港区", "1234567890123", "20240507", 2024, 1234000)
    two = spark.createDataFrame([("f", 1, 0, "部品 1,000,000 2,000,000"), ("f", 1, 1, "金1,000,000円")], df.schema)
    assert sorted((r.line, r.contract_amount) for r in pages.line_records(two).collect()) == [(0, 1000000), (0, 2000000)]  # no word border after 金


def test_scan_records(spark):
    columns = [(0.2, "contract_name"), (0.4, "contract_date"), (0.6, "vendor"), (0.8, "contract_amount"), (1.0, "notes")]
    rows = [
        ("件名の甲", 0.1, 0.30), ("令和G年s月1日", 0.3, 0.31), ("甲株式会社", 0.5, 0.29), ("東京都", 0.5, 0.31), ("1234567890123", 0.5, 0.32), ("1,500,000", 0.7, 0.30),
        ("件名の乙", 0.1, 0.52), ("乙商会", 0.5, 0.50), ("2,500,000", 0.7, 0.50), ("9,999", 0.7, 0.6), ("※注", 0.1, 0.5), ("5,000,000", 0.7, 0.95),
    ]
    df = spark.createDataFrame([("f", 1, i, t, x, y, 0.9) for i, (t, x, y) in enumerate(rows)], "file_id string, page int, seq int, text string, x double, y double, conf double")
    got = sorted(pages.scan_records(df, columns, 0.2, 0.9, 0.06).collect(), key=lambda r: r.anchor)
    assert [(r.contract_name, r.vendor_name, r.vendor_address, r.corporate_number, r.contract_date, r.contract_amount) for r in got] == [
        ("件名の甲", "甲株式会社", "東京都", "1234567890123", "20240501", 1500000), ("件名の乙", "乙商会", None, None, None, 2500000)]


def test_ranked_items(spark):
    rows = [word("1", 10, 50), word("甲重工", 60, 50), word("123,456", 200, 50), word("戦車、護衛艦、", 300, 46), word("輸送機", 300, 54), word("2", 10, 100), word("乙電機", 60, 100), word("通信機。12", 300, 100)]
    df = spark.createDataFrame(rows, WORDS)
    got = sorted((r["rank"], r.company_name, r.item_order, r.item_name) for r in pages.ranked_items(df, 30, (40, 150), (250, 400), 2.0).collect())
    assert got == [(1, "甲重工", 1, "護衛艦"), (1, "甲重工", 2, "輸送機"), (2, "乙電機", 1, "通信機")]
    lines = sorted((r["rank"], r.item_order, r.item_name) for r in pages.ranked_items(df, 30, (40, 150), (250, 400), 2.0, split=False).collect())
    assert lines == [(1, 1, "戦車、護衛艦、"), (1, 2, "輸送機"), (2, 1, "通信機。12")]


def test_companies(spark):
    cells = [["順位", "企業名", "件数", "金額", "比率"], ["1", "甲重工", "120", "3,000", "15.5%"], ["2", "乙電機", "80", "1,500", "7.5%"], ["30", "丙", "1", "1", "1"], ["x", "丁", "1", "2", "3"]]
    df = spark.createDataFrame([("f", i, c) for i, c in enumerate(cells)], "file_id string, row int, cells array<string>")
    got = sorted(map(tuple, pages.companies(df).collect()))
    assert got == [("f", 1, "甲重工", 120, 3000.0, 15.5), ("f", 2, "乙電機", 80, 1500.0, 7.5)]
    millions = spark.createDataFrame([("g", 0, ["位", "会社"]), ("g", 1, ["1", "甲", "120", "300,000"])], df.schema)
    assert pages.companies(millions).first().amount_100m == 3000.0


def test_bands_are_worked_out_before_their_words(spark):
    df = spark.createDataFrame([("f", 1, 0, "1,000,000", 0.9, 0.5, 0.9)], "file_id string, page int, seq int, text string, x double, y double, conf double")
    out = pages.scan_records(df, [(0.5, "contract_date"), (1.0, "contract_amount")], 0.0, 1.0, 0.1)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 1 and not [line for line in plan.splitlines() if "lambdafunction" in line and "array_position" in line and "between" not in line and "filter(items" in line]


def test_a_date_is_read_once(spark):
    for read in (dates.scan_date, dates.page_date):
        told = spark.sql("select '令和6年4月1日' as t").select(read(F.col("t")).alias("d"))
        assert told.first().d == "20240401"
        plan = told._jdf.queryExecution().analyzed().toString()
        assert plan.count("trim(") == 1 and plan.count("regexp_extract(") <= 9  # three parts of each of three forms


def test_lines_are_told_once(spark):
    df = spark.createDataFrame([("f", 1, 0, "航空機用部品の製造"), ("f", 1, 1, "٣٤٥,٠٠٠,١١١ 1，500，000 200,000 99,999"), ("f", 1, 2, "R6 . 13 . 1"), ("f", 1, 3, "R 6 . 4 . 1"), ("f", 1, 4, "12345 67890 123")], "file_id string, page int, line int, text string")
    out = pages.line_records(df)
    got = sorted((r.contract_amount, r.contract_name, r.vendor_name, r.contract_date, r.corporate_number) for r in out.collect())
    assert got == [(a, "航空機用部品の製造", "航空機用部品の製造", "20240401", "1234567890123") for a in (200_000, 1_500_000)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(pages.DATE) == 1 and plan.count("合計") == 1 and "format_string" not in plan  # not for each line near it
